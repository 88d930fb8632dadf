"""A measured run over generated payments, and the laboratory of failures that must be caught."""

from __future__ import annotations

import hashlib
import html
import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import identity, lifecycle, manifest, posting, settlement
from ..sources import arrivals, control, generator
from ..sources.files import Files
from ..sources.tables import TableStore
from . import marts, workflow

PROFILES = {"smoke": 5_000, "evidence": 50_000, "stress": 250_000}


def canonical(x: object) -> str:
    return json.dumps(x, sort_keys=True, separators=(",", ":"))


def summarise(store: TableStore, run: str) -> dict:
    """Counts, balances and the state hash of the tables, and of one run's outcomes."""
    outcomes = store.read("run_outcome").filter(F.col("run_id") == run)
    kept = identity.conservation(outcomes).first().asDict()
    ledger = store.read("ledger_entry")
    groups = settlement.expected(ledger)
    return {
        **kept,
        "quarantine_reasons": {r["reason"]: r["n"] for r in outcomes.filter("outcome = 'QUARANTINED'").groupBy("reason").agg(F.count("*").alias("n")).orderBy("reason").collect()},
        "accepted_events": store.read("accepted_event").count(),
        "payment_states": store.read("payment_state").count(),
        "business_exceptions": store.read("business_exception").count(),
        "posted_events": store.read("posted_event").count(),
        "ledger_entries": ledger.count(),
        "ledger_balance_minor": ledger.agg(F.coalesce(F.sum("signed_minor"), F.lit(0))).first()[0],
        "unbalanced_groups": posting.unbalanced(ledger).count(),
        "settlement_groups": groups.count(),
        "state_sha256": marts.state_hash(store.read("payment_state")).first()["state_sha256"],
        "clear_email_leaks": store.read("accepted_event").filter(F.to_json(F.struct("*")).contains("@")).count(),
    }


def _raises(action: Callable[[], object], text: str) -> bool:
    try:
        action()
    except Exception as error:  # the scenario is that the right one is raised
        return text in str(error)
    return False


def _small(spark: SparkSession, rows: list[tuple[str, int, str, int]]) -> DataFrame:
    """Accepted events (transaction, version, type, amount) of one processor and currency."""
    made = [(f"{t}:v{v}", t, v, "checkout-01", "processor-01", "merchant-001", kind, amount, "INR", None) for t, v, kind, amount in rows]
    schema = "event_id string, transaction_id string, transaction_version long, source_id string, processor_id string, merchant_id string, event_type string, amount_minor long, currency string, customer_token string"
    at = F.to_timestamp(F.lit("2026-01-01 00:00:00"))
    return spark.createDataFrame(made, schema).withColumns({"event_time": at, "received_at": at})


def write_lines(spark: SparkSession, folder: str, least_records: int) -> str:
    """Generated arrivals as one file of JSON lines, in order; its path."""
    path = f"{folder}/arrivals"
    generator.arrivals(spark, least_records).orderBy("ordinal").select("value").coalesce(1).write.mode("overwrite").text(path)
    return next(p for p in spark.read.text(path).inputFiles() if "/part-" in p)


def load_twice(spark: SparkSession, store: TableStore, lines: DataFrame, registry: DataFrame, key: bytes, rules: DataFrame | None = None) -> tuple[float, float]:
    """Seconds to take the arrivals in, and to take them in again in another order."""
    taken = []
    for name, rows in (("initial", lines), ("replay", lines.withColumn("ordinal", -F.col("ordinal")))):
        began = time.time()
        workflow.process(store, rows, registry, key, name, rules)
        taken.append(time.time() - began)
    return taken[0], taken[1]


def measure(spark: SparkSession, folder: str, profile: str, key: bytes = b"key of measured runs, of 32 bytes") -> dict:
    """Times of the two loads of a profile, after one small load that starts the machine."""
    registry = control.registry(spark)
    warm = arrivals.read_lines(spark, write_lines(spark, f"{folder}/warm", 500))
    load_twice(spark, TableStore(spark, f"{folder}/warm-tables"), warm, registry, key)
    lines = arrivals.read_lines(spark, write_lines(spark, folder, PROFILES[profile]))
    elapsed, replayed = load_twice(spark, TableStore(spark, f"{folder}/tables"), lines, registry, key)
    return {"elapsed_seconds": round(elapsed, 3), "replay_seconds": round(replayed, 3), "records_per_second": round(lines.count() / elapsed, 1)}


def run(spark: SparkSession, profile: str, folder: str, key: bytes, least_records: int | None = None, registry_file: str | None = None, rules_file: str | None = None) -> dict:
    """Generates, takes in, replays and settles; runs every scenario; writes summary.json and report.html."""
    files, store = Files(spark), TableStore(spark, f"{folder}/tables")
    registry = control.registry(spark, registry_file)
    rules = posting.rules_frame(spark, *control.posting_rules(spark, rules_file)) if rules_file else None
    name = write_lines(spark, folder, least_records or PROFILES[profile])
    listed = manifest.build(spark, name)
    manifest.verify(spark, listed, name)
    lines = arrivals.read_lines(spark, name)
    elapsed, replayed = load_twice(spark, store, lines, registry, key, rules)
    first, second = summarise(store, "initial"), summarise(store, "replay")
    scenarios = _scenarios(spark, store, folder, lines, registry, key, listed, name, first, second)
    summary = {
        "classification": "SYNTHETIC",
        "profile": profile,
        "manifest": listed | {"file_name": "arrivals.jsonl"},
        "initial": first,
        "replay": second,
        "elapsed_seconds": round(elapsed, 6),
        "records_per_second": round(first["arrivals"] / elapsed, 2),
        "replay_seconds": round(replayed, 6),
        "scenarios": scenarios,
        "scenarios_passed": sum(s["passed"] for s in scenarios),
        "sealed_sha256": "",
    }
    summary["sealed_sha256"] = hashlib.sha256(canonical(summary).encode()).hexdigest()
    files.write(f"{folder}/summary.json", json.dumps(summary, indent=2, sort_keys=True) + "\n")
    rows = "".join(f"<tr><td>{html.escape(s['name'])}</td><td>{'passed' if s['passed'] else 'FAILED'}</td></tr>" for s in scenarios)
    files.write(f"{folder}/report.html", f"<!doctype html><title>Run {html.escape(profile)}</title><h1>{first['arrivals']} arrivals</h1><table>{rows}</table><pre>{html.escape(json.dumps(first, indent=2))}</pre>")
    if failed := [s["name"] for s in scenarios if not s["passed"]]:
        raise RuntimeError("failed scenarios: " + ", ".join(failed))
    return summary


def _scenarios(spark, store, folder, lines, registry, key, listed, name, first, second) -> list[dict]:
    with store.commit("settlement-expected") as change:
        change.replace("expected_settlement", settlement.expected(change.read("ledger_entry")))
    expected = store.read("expected_settlement")
    evidence = expected.withColumnRenamed("expected_minor", "amount_minor")
    day = expected.agg(F.min("business_date").cast("string")).first()[0]
    reconcile = lambda rows, run: workflow.reconcile(store, rows, day, run, strict=False)
    matched = reconcile(evidence, "settle-match")
    one = expected.filter(F.col("business_date") == day).orderBy("processor_id", "currency").first()
    off = (F.col("business_date") == day) & (F.col("processor_id") == one["processor_id"]) & (F.col("currency") == one["currency"])
    short = reconcile(evidence.withColumn("amount_minor", F.col("amount_minor") - F.when(off, 101).otherwise(0)), "settle-short")
    recovered = reconcile(evidence, "settle-again")
    lonely = lifecycle.assess(_small(spark, [("t", 1, "capture", 5)]))
    gap = _small(spark, [("t", 1, "authorization", 5), ("t", 3, "capture", 5)])
    one_sided = posting.post(_small(spark, [("t", 1, "capture", 5)]), posting.rules_frame(spark)).filter("signed_minor > 0")
    crashed = TableStore(spark, f"{folder}/crashed")
    crash = lambda: workflow.process(crashed, lines.limit(20), registry, key, "crash", failpoint="before_commit")
    turned = TableStore(spark, f"{folder}/turned")
    workflow.process(turned, lines.filter("ordinal % 3 = 0").unionByName(lines.filter("ordinal % 3 <> 0")), registry, key, "initial")
    reasons = first["quarantine_reasons"]
    # Reports are compared by these names.
    checks = {
        "manifest_checksum_gate": _raises(lambda: manifest.verify(spark, listed | {"sha256": "0" * 64}, name), "manifest_differs:sha256"),
        "raw_outcome_reconciliation": first["conserved"],
        "identity_payload_conflict": reasons.get("identity_payload_conflict", 0) >= 1,
        "prohibited_card_field": reasons.get("prohibited_fields:card_number", 0) >= 1,
        "double_entry_balance": first["unbalanced_groups"] == 0 and first["ledger_balance_minor"] == 0,
        "unbalanced_rule_detector": _raises(lambda: posting.require_balanced(one_sided), "double-entry gate failed"),
        "exact_replay_no_second_effect": second["accepted"] == 0 and all(first[k] == second[k] for k in ("ledger_entries", "accepted_events", "state_sha256")),
        "crash_before_commit": _raises(crash, "before_commit") and crashed.read("accepted_event").isEmpty() and workflow.journal(crashed).first()["status"] == "FAILED",
        "lifecycle_violation": lonely.filter("business_error = 'capture_without_authorization'").count() == 1,
        "transaction_version_gap": lifecycle.business_exceptions(gap, lifecycle.assess(gap)).filter("business_error = 'transaction_version_gap'").count() == 2,
        "settlement_match": matched["gate_open"] and matched["absolute_delta_minor"] == 0,
        "settlement_mismatch_gate": not short["gate_open"] and short["absolute_delta_minor"] == 101,
        "settlement_recovery": recovered["gate_open"],
        "clear_email_exclusion": first["clear_email_leaks"] == 0,
        "out_of_order_determinism": summarise(turned, "initial")["state_sha256"] == first["state_sha256"],
    }
    return [{"name": n, "passed": bool(ok)} for n, ok in checks.items()]
