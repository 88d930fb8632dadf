"""The payment engine on literal rows, on the samples' golden counts, and against its own second forms."""

from __future__ import annotations

import base64
import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from paytrail import catalog, vocabulary
from paytrail.functions import secrets
from paytrail.functions.times import instant, time_reason
from paytrail.operators import contract, identity, lifecycle, manifest, merging, posting, revisions, settlement
from paytrail.plans import evidence, marts, workflow
from paytrail.sources import arrivals, control, generator, tables
from paytrail.sources.tables import TableStore
from paytrail.streaming import gate

SAMPLE = "/root/testdata/sf0.001"
KEY = b"0123456789abcdef0123456789abcdef"
BASE = {
    "schema_version": "1.0",
    "event_id": "e-1",
    "transaction_id": "t-1",
    "transaction_version": 1,
    "source_id": "checkout-01",
    "processor_id": "processor-01",
    "merchant_id": "merchant-01",
    "event_type": "authorization",
    "amount_minor": 10_000,
    "currency": "INR",
    "event_time": "2026-01-01T00:01:00+00:00",
    "received_at": "2026-01-01T00:01:05Z",
    "customer_email": " Person@Example.TEST ",
}


def lines(spark, *values):
    rows = [(i, v if isinstance(v, str) or v is None else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ordinal long, value string")


def without(field):
    return {k: v for k, v in BASE.items() if k != field}


CASES = [
    (BASE, None),
    (without("customer_email"), None),
    (BASE | {"customer_email": None}, None),
    (BASE | {"card_number": "4"}, "prohibited_fields:card_number"),
    (json.dumps(BASE)[:-1] + ', "amount_minor": 7}', None),
    (json.dumps(BASE)[:-1] + ', "amount_minor": -7}', "invalid_amount_minor"),
    ('{"amount_minor": -7, ' + json.dumps(BASE)[1:], None),
    (json.dumps(BASE)[:-1] + ', "pin": 1, "pin": null}', "prohibited_fields:pin"),
    (BASE | {"x": {"y": [{"CVV": 1, "Pan": 2}]}}, "prohibited_fields:cvv,pan"),
    (json.dumps(BASE | {"pin": 1}).replace('"pin"', '"p\\u0069n" '), "prohibited_fields:pin"),
    (BASE | {"trac\u212a_data": 1}, "prohibited_fields:track_data"),
    (BASE | {'a"pin': 1}, 'unexpected_fields:a"pin'),
    (BASE | {"customer_email": '"pin": x@y'}, None),
    ({k: v for k, v in BASE.items() if k not in ("currency", "amount_minor")}, "missing_fields:amount_minor,currency"),
    (BASE | {"surprise": 1, "another": 2}, "unexpected_fields:another,surprise"),
    (BASE | {"schema_version": "9.9"}, "unsupported_schema_version"),
    (BASE | {"schema_version": 1.0}, "unsupported_schema_version"),
    (BASE | {"event_id": "a b"}, "invalid_event_id"),
    (BASE | {"event_id": "x" * 129}, "invalid_event_id"),
    (BASE | {"transaction_id": "line\n"}, "invalid_transaction_id"),
    (BASE | {"merchant_id": 7}, "invalid_merchant_id"),
    (BASE | {"source_id": "nobody-01"}, "unknown_source"),
    (BASE | {"source_id": "processor_settlement-01"}, "source_contract_mismatch"),
    (BASE | {"transaction_version": 0}, "invalid_transaction_version"),
    (BASE | {"transaction_version": True}, "invalid_transaction_version"),
    (BASE | {"event_type": "void"}, "unsupported_event_type"),
    (BASE | {"amount_minor": 100.25}, "invalid_amount_minor"),
    (BASE | {"amount_minor": -1}, "invalid_amount_minor"),
    (json.dumps(BASE).replace("10000", "1e4"), "invalid_amount_minor"),
    (json.dumps(BASE).replace("10000", "100.0"), "invalid_amount_minor"),
    (BASE | {"amount_minor": "100"}, "invalid_amount_minor"),
    (BASE | {"amount_minor": 1 << 70}, "invalid_amount_minor"),
    (BASE | {"currency": "JPY"}, "unsupported_currency"),
    (BASE | {"event_time": "yesterday"}, "invalid_event_time"),
    (BASE | {"event_time": "2026-02-30T00:00:00Z"}, "invalid_event_time"),
    (BASE | {"event_time": "2026-01-01T00:00:00"}, "timezone_required:event_time"),
    (BASE | {"received_at": "2026-01-01"}, "timezone_required:received_at"),
    (BASE | {"customer_email": "nobody"}, "invalid_customer_email"),
    (BASE | {"customer_email": 5}, "invalid_customer_email"),
    ({"metadata": {"table-name": "payment_outbox", "operation": "insert"}, "data": BASE}, None),
    ({"metadata": {"table-name": "payment_outbox", "operation": "update"}, "data": BASE}, "non_insert_outbox_mutation"),
    ({"metadata": {"table-name": "other", "operation": "insert"}, "data": BASE}, "unsupported_cdc_table"),
    ({"metadata": 1, "data": BASE}, "invalid_cdc_envelope"),
    ("[1]", "non_object_event"),
    ("", "invalid_json"),
    (None, "invalid_json"),
]


def test_contract_gives_the_first_reason(spark):
    out = contract.check(lines(spark, *(c for c, _ in CASES)), control.registry(spark), KEY).orderBy("ordinal").collect()
    assert [(i, r["reason"]) for i, r in enumerate(out)] == [(i, reason) for i, (_, reason) in enumerate(CASES)]
    token = hmac.new(KEY, b"person@example.test", hashlib.sha256).hexdigest()
    assert out[0]["customer_token"] == token and out[1]["customer_token"] is None
    short = contract.check(lines(spark, BASE, without("customer_email")), control.registry(spark), b"short").orderBy("ordinal").collect()
    assert [r["reason"] for r in short] == ["token_key_too_short", None]


def test_fingerprint_is_the_canonical_digest(spark):
    odd = BASE | {"customer_email": " Zoë@Exämple.test\t", "received_at": "2027-01-01T00:00:00Z"}
    rows = [BASE, odd, without("customer_email"), BASE | {"customer_email": None}]
    out = contract.check(lines(spark, *rows), control.registry(spark), KEY).orderBy("ordinal").collect()
    for row, got in zip(rows, out, strict=True):
        own = {k: v for k, v in row.items() if k != "received_at"}
        if own.get("customer_email"):
            own["customer_email"] = own["customer_email"].strip().lower()
        assert got["fingerprint"] == hashlib.sha256(json.dumps(own, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def test_redaction_at_any_depth(spark):
    raw = {"customer_email": "a@b", "n": [{"CVV": "1", "ok": [1, {"Pan": 2}]}], "pin": {"x": 1}}
    (out,) = lines(spark, raw).select(secrets.redacted(F.col("value"))).first()
    lost = [r[0] for r in lines(spark, "[" * 200_000, "{", None).select(secrets.redacted(F.col("value"))).collect()]
    assert json.loads(lost[0])["unreadable_bytes"] == 200_000 and json.loads(lost[1])["unreadable_sha256"] == hashlib.sha256(b"{").hexdigest() and lost[2] is None
    assert json.loads(out) == {"customer_email": "<redacted>", "n": [{"CVV": "<redacted>", "ok": [1, {"Pan": "<redacted>"}]}], "pin": "<redacted>"}


def test_times(spark):
    texts = ["2026-01-01T00:30:00+05:30", "2026-01-01 00:30:00Z", "2026-01-01T00:30:00.123456-01:00", "2026-01-01", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.to_date(instant(F.col("t"))).cast("string").alias("d"), time_reason(F.col("t"), "f").alias("r"))
    assert [tuple(r) for r in df.collect()] == [("2025-12-31", None), ("2026-01-01", None), ("2026-01-01", None), (None, "timezone_required:f"), (None, "invalid_f"), (None, "invalid_f")]


def test_identity_by_arrival_order(spark):
    rows = [(0, "a", "x"), (1, "a", "x"), (2, "a", "y"), (3, "b", "z"), (4, "c", "q"), (5, "c", "w")]
    valid = spark.createDataFrame(rows, "ordinal long, event_id string, fingerprint string")
    seen = spark.createDataFrame([("c", "w")], "event_id string, fingerprint string")
    out = [(r["ordinal"], r["outcome"]) for r in identity.classify(valid, seen).orderBy("ordinal").collect()]
    assert out == [(0, "ACCEPTED"), (1, "DUPLICATE"), (2, "QUARANTINED"), (3, "ACCEPTED"), (4, "QUARANTINED"), (5, "DUPLICATE")]
    turned = valid.withColumn("ordinal", -F.col("ordinal"))
    assert {r["ordinal"]: r["outcome"] for r in identity.classify(turned).collect()}[-2] == "ACCEPTED"


A, C, R, B = "authorization", "capture", "refund", "chargeback"
HISTORIES = {
    "AUTHORIZED": [(1, A, 100)],
    "CAPTURED": [(1, A, 100), (2, C, 100)],
    "PARTIALLY_CAPTURED": [(1, A, 100), (2, C, 60)],
    "PARTIALLY_REFUNDED": [(3, R, 25), (1, A, 100), (2, C, 100)],
    "REFUNDED": [(1, A, 100), (2, C, 100), (3, R, 60), (4, R, 40)],
    "PARTIALLY_CHARGEDBACK": [(1, A, 100), (2, C, 100), (3, B, 1)],
    "CHARGEDBACK": [(1, A, 100), (2, C, 100), (3, R, 40), (4, B, 60)],
    "transaction_version_conflict": [(1, A, 100), (1, A, 100)],
    "transaction_version_gap": [(1, A, 100), (3, C, 100)],
    "duplicate_authorization": [(1, A, 100), (2, A, 100)],
    "capture_without_authorization": [(1, C, 100)],
    "missing_authorization": [(1, R, 100)],
    "capture_before_authorization": [(1, C, 100), (2, A, 100)],
    "reversal_without_capture": [(1, A, 100), (2, R, 100)],
    "reversal_before_capture": [(1, A, 100), (2, R, 10), (3, C, 100)],
    "capture_exceeds_authorization": [(1, A, 100), (2, C, 150)],
    "refund_or_chargeback_exceeds_capture": [(1, A, 100), (2, C, 100), (3, R, 101)],
}


def history(spark):
    rows = [(name, v, kind, amount, "INR", "processor-01", "merchant-01") for name, h in HISTORIES.items() for v, kind, amount in h]
    for field, name in ((4, "currency_mutation"), (5, "processor_mutation"), (6, "merchant_mutation")):
        for v, kind in ((1, A), (2, C)):
            row = [name, v, kind, 100, "INR", "processor-01", "merchant-01"]
            if v == 2:
                row[field] = "other"
            rows.append(tuple(row))
    df = spark.createDataFrame(rows, "transaction_id string, transaction_version long, event_type string, amount_minor long, currency string, processor_id string, merchant_id string")
    at = F.to_timestamp(F.lit("2026-01-01 00:00:00"))
    return df.withColumns({"event_id": F.concat_ws(":", "transaction_id", "transaction_version", "event_type"), "event_time": at})


def test_every_status_and_every_reason(spark):
    events = history(spark)
    for assessed in (lifecycle.assess(events), lifecycle.assess_by_window(events).filter("state_rank = 1")):
        for name, error in assessed.select("transaction_id", "business_error").collect():
            assert error == (None if name.isupper() else name)
    state = {r["transaction_id"]: r["status"] for r in lifecycle.current_state(lifecycle.assess(events)).collect()}
    assert all(name == status for name, status in state.items()) and len(state) == 7
    bad = lifecycle.business_exceptions(events, lifecycle.assess(events))
    assert bad.count() == events.count() - sum(len(h) for n, h in HISTORIES.items() if n.isupper())


def test_posting_balances_and_refuses_bad_rules(spark):
    events = history(spark)
    ledger = posting.post(posting.postable(events, lifecycle.assess(events)), posting.rules_frame(spark))
    posting.require_balanced(ledger)
    assert marts.repeated(ledger, "entry_id").isEmpty() and ledger.count() == 2 * posting.postable(events, lifecycle.assess(events)).count()
    with pytest.raises(RuntimeError, match="double-entry"):
        posting.require_balanced(ledger.filter("signed_minor > 0"))
    rules = {A: (), C: (("a", 1), ("b", -1)), R: (("a", 1), ("b", -1)), B: (("a", 1), ("b", -1))}
    posting.check_rules(rules, 1, "minor")
    for bad, version, unit in ((rules, True, "minor"), (rules, 1, "major"), ({C: ()}, 1, "minor"), (rules | {C: (("a", 1),)}, 1, "minor")):
        with pytest.raises(ValueError):
            posting.check_rules(bad, version, unit)


def test_registry(spark):
    assert control.registry(spark).groupBy("contract").count().orderBy("contract").collect() == [("payment_event", 17), ("settlement_evidence", 3)]
    good = {"family": "f", "instances": 1, "mode": "stream", "contract": "payment_event", "owner": "o", "freshness_minutes": 5}
    for change, reason in (({"mode": "fax"}, "unsupported_source_mode:fax"), ({"contract": "x"}, "unsupported_source_contract:x"), ({"instances": True}, "invalid_source_instances"), ({"freshness_minutes": 0}, "invalid_freshness_minutes")):
        with pytest.raises(ValueError, match=reason):
            control.expand_families([good | change])
    with pytest.raises(ValueError, match="duplicate_source:f-01"):
        control.expand_families([good, good])
    with pytest.raises(ValueError, match="source_family_missing:mode,owner"):
        control.expand_families([{k: v for k, v in good.items() if k not in ("mode", "owner")}])
    with pytest.raises(ValueError, match="empty_source_registry"):
        control.expand_families([])


def test_lines_keep_their_order_and_blank_ones(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"n":0}\n\n{"n":2}\n')
    (tmp_path / "b.jsonl").write_text('{"n":3}\n[4]\n')
    got = [r["value"] for r in arrivals.read_lines(spark, str(tmp_path)).orderBy("ordinal").collect()]
    assert got == ['{"n":0}', "", '{"n":2}', '{"n":3}', "[4]"]
    with pytest.raises(ValueError, match="invalid_json_line:2"):
        arrivals.require_objects(arrivals.read_lines(spark, str(tmp_path)))


def test_manifest(spark, tmp_path):
    path = tmp_path / "daily.jsonl"
    path.write_text("".join(json.dumps({"amount_minor": a, "currency": c}) + "\n" for a, c in ((100, "INR"), (50, "INR"), (75, "USD"))))
    made = manifest.build(spark, f"file://{path}", 7)
    assert (made["record_count"], made["raw_control_totals_minor"]) == (3, {"INR": 150, "USD": 75})
    manifest.verify(spark, made, f"file://{path}")
    for field, value in (("file_name", "x"), ("sha256", "0" * 64), ("record_count", 4)):
        with pytest.raises(ValueError, match=f"manifest_differs:{field}"):
            manifest.verify(spark, made | {field: value}, f"file://{path}")
    path.write_text(path.read_text() + "{}\n")
    with pytest.raises(ValueError, match="byte_size"):
        manifest.verify(spark, made, f"file://{path}")
    for bad in ({}, made | {"x": 1}, made | {"version": 2}, made | {"revision": 0}, made | {"byte_size": 6_000_000_000}):
        with pytest.raises(ValueError):
            manifest.check_controls(bad)


def test_revisions(spark):
    got = {(r["business_date"], r["revision"], r["sha256"]): r["decision"] for r in catalog.queries()["revision_registry_decision"](spark, SAMPLE).collect()}
    assert got[("2026-01-01", 3, "dd")] == "ACTIVE" and got[("2026-01-01", 2, "ee")] == "CONFLICT" and got[("2026-01-02", 1, "ff")] == "STALE"
    assert revisions.decide


def test_merges(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "x"), (3, "y"), (3, "z")], "k int, v string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(merging.insert_only(target, source, ["k"])) == [(1, "a"), (2, "b"), (3, "y")]
    assert rows(merging.upsert(target, source, ["k"])) == [(1, "a"), (2, "x"), (3, "y")]
    assert rows(merging.overwrite_where(target, source.limit(0), F.col("k") == 2)) == [(1, "a")]


def test_table_store(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/t")
    frame = lambda *ks: spark.createDataFrame([(k, f"v{k}") for k in ks], "k int, v string")
    with store.commit("one") as change:
        change.insert_new("a", frame(1, 2), ["k"])
        change.append("b", frame())
    with pytest.raises(RuntimeError), store.commit("two") as change:
        change.replace("a", frame(9))
        raise RuntimeError("crash")
    assert store.read("a").count() == 2 and store.read("b").count() == 0
    with pytest.raises(ValueError, match="already committed"), store.commit("one"):
        pass
    with store.commit("three") as change:
        change.insert_new("a", frame(2, 3), ["k"])
    assert sorted(r["k"] for r in store.read("a").collect()) == [1, 2, 3]
    store.compact("a", 1)
    assert store.read("a").count() == 3 and store.read("a", 0).count() == 2
    with pytest.raises(ValueError, match="retention"):
        store.expire(3)
    assert store.expire(7) == []
    assert store.expire(7, now=4e9) and store.read("a").count() == 3


def test_settlement_gates(spark):
    day = "2026-01-01"
    rows = spark.createDataFrame([("1.0", "processor-01", "INR", 5), ("1.0", "processor-01", None, 5), ("2.0", "processor-01", "USD", 5)], "schema_version string, processor_id string, currency string, amount_minor long").withColumn("business_date", F.to_date(F.lit(day)))
    assert settlement.violations(rows, day).count() == 2
    good = rows.limit(1)
    workflow.validate_evidence(good, {"record_count": 1, "raw_control_totals_minor": {"INR": 5}}, day)
    for frame, totals, n, why in ((rows, {"INR": 5, "USD": 5}, 3, ":contract$"), (good.union(good), {"INR": 10}, 2, ":keys$"), (good, {"INR": 5}, 2, ":records$"), (good, {"INR": 6}, 1, ":totals$"), (rows, {}, 9, ":contract,records,totals$")):
        with pytest.raises(RuntimeError, match=why):
            workflow.validate_evidence(frame, {"record_count": n, "raw_control_totals_minor": totals}, day)


def test_golden_counts(spark):
    state = {r["status"]: r["n"] for r in catalog.queries()["payment_state_status_counts"](spark, SAMPLE).collect()}
    assert state == {"AUTHORIZED": 26, "CAPTURED": 204, "CHARGEDBACK": 64, "PARTIALLY_CAPTURED": 132, "PARTIALLY_CHARGEDBACK": 458, "PARTIALLY_REFUNDED": 225, "REFUNDED": 38}
    errors = {r["business_error"]: r["n"] for r in catalog.queries()["business_error_counts"](spark, SAMPLE).collect()}
    assert (errors["reversal_without_capture"], errors["refund_or_chargeback_exceeds_capture"], sum(errors.values())) == (73, 87, 353)


def test_generator_formulas(spark):
    assert generator.transactions_for(50_000) == 21_605
    rows = generator.valid_events(spark, 50_000)
    assert rows.count() == 50_000
    raw = generator.arrivals(spark, 50_000)
    totals = manifest.raw_totals(raw)
    assert totals == (50_087, {"EUR": 2_858_122_328, "GBP": 2_859_341_051, "INR": 2_855_986_069, "USD": 2_859_556_943})


def test_evidence_run_passes_every_scenario(spark, tmp_path):
    summary = evidence.run(spark, "smoke", f"file://{tmp_path}", KEY, least_records=300)
    assert summary["scenarios_passed"] == len(summary["scenarios"]) == 15
    sealed = json.loads((tmp_path / "summary.json").read_text())
    seal = sealed.pop("sealed_sha256")
    assert seal == hashlib.sha256(evidence.canonical(sealed | {"sealed_sha256": ""}).encode()).hexdigest()


def test_stream_equals_batch(spark):
    name = {r["ordinal"]: (r["outcome"], r["reason"]) for r in catalog.queries()["identity_outcomes"](spark, SAMPLE).collect()}
    stream = {r["ordinal"]: (r["outcome"], r["reason"]) for r in catalog.queries()["stream_identity_gate"](spark, SAMPLE).collect()}
    assert stream == name and len(name) > 7_000


def test_settlement_workflow(spark, tmp_path):
    root, day = f"file://{tmp_path}", "2026-01-01"
    store = TableStore(spark, f"{root}/tables")
    workflow.process(store, generator.arrivals(spark, 200), control.registry(spark), KEY, "run")
    rows = settlement.expected(store.read("ledger_entry")).filter(F.col("business_date") == F.to_date(F.lit(day))).collect()
    folder = tmp_path / "in" / f"business_date={day}"
    folder.mkdir(parents=True)
    (folder / "daily.jsonl").write_text("".join(json.dumps({"schema_version": "1.0", "business_date": day, "processor_id": r["processor_id"], "currency": r["currency"], "amount_minor": r["expected_minor"]}) + "\n" for r in rows))
    made = manifest.build(spark, f"{root}/in/business_date={day}/daily.jsonl", 7)
    (folder / "daily.manifest.json").write_text(json.dumps(made))
    load = lambda: manifest.load(spark, f"{root}/in", f"business_date={day}/daily.manifest.json", f"{root}/verified", store)
    with pytest.raises(ValueError, match="not_a_dated_manifest"):
        manifest.load(spark, f"{root}/in", "daily.manifest.json", f"{root}/verified", store)
    took = load()
    assert took["status"] == "VERIFIED" and load()["status"] == "RECOVERED_DUPLICATE"
    found = workflow.validate_evidence(workflow.read_evidence(spark, took["verified_path"]), took["manifest"], day)
    assert workflow.reconcile(store, found, day, "reconcile")["gate_open"]
    with pytest.raises(RuntimeError, match="not reconciled"):
        workflow.require_reconciled(store, day)
    assert workflow.publish(store, root, day, 6, took["sha256"]) == "SUPERSEDED"
    assert workflow.publish(store, root, day, 7, took["sha256"]) == "RECONCILED"
    workflow.require_reconciled(store, day)
    assert load()["status"] == "DUPLICATE_MANIFEST"
    (folder / "daily.manifest.json").write_text(json.dumps(made | {"revision": 6}))
    assert load()["status"] == "STALE_MANIFEST"
    with pytest.raises(RuntimeError, match="settlement_gate_shut"):
        workflow.reconcile(store, found.withColumn("amount_minor", F.col("amount_minor") + 1), day, "short")
    assert store.read("settlement_exception").count() == len(rows)  # kept although the gate stopped
    workflow.reconcile(store, found, day, "again")
    with pytest.raises(RuntimeError, match="stale_sources:accepted_event,payment_state"):
        workflow.build_marts(store, day, "marts-late")
    latest = store.read("accepted_event").agg(F.max("received_at").cast("string")).first()[0]
    assert set(workflow.build_marts(store, day, "marts", latest).values()) == {"pass"}
    assert store.read("dim_payment_current").count() == store.read("payment_state").count()
    assert marts.source_verdicts(store.read("accepted_event"), control.registry(spark), latest).count() == 17


def test_manifests_as_a_stream(spark, tmp_path):
    root, day = f"file://{tmp_path}", "2026-01-01"
    store = TableStore(spark, f"{root}/tables")
    folder = tmp_path / "in" / f"business_date={day}"
    folder.mkdir(parents=True)
    (folder / "a.jsonl").write_text('{"amount_minor":1,"currency":"INR"}\n')
    (folder / "a.manifest.json").write_text(json.dumps(manifest.build(spark, f"{root}/in/business_date={day}/a.jsonl")))
    (folder / "b.jsonl").write_text("{}\n")
    (folder / "b.manifest.json").write_text("{}")
    run = lambda: gate.start_manifests(spark, f"{root}/in", f"{root}/verified", store, f"{root}/checkpoint").awaitTermination()
    run()
    run()
    told = {r["path"].rsplit("/", 1)[-1]: r for r in store.read("manifest_outcome").collect()}
    assert told["a.manifest.json"]["status"] == "VERIFIED" and told["b.manifest.json"]["reason"].startswith("manifest_fields")


def test_records_that_cannot_be_read_do_not_stop_the_stream(spark, tmp_path):
    encode = lambda t: base64.b64encode(t if isinstance(t, bytes) else t.encode()).decode()
    deep = "[" * 200_000
    texts = [encode(json.dumps(BASE)), encode(deep), "no base64!", encode(b"\xff\xfe"), encode(json.dumps(BASE | {"pin": 1})), encode(json.dumps(BASE | {"amount_minor": 5})), encode(json.dumps(BASE)), None]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "ordinal long, data string").coalesce(1).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema("ordinal long, data string").parquet(f"file://{tmp_path}/in")
    store = TableStore(spark, f"file://{tmp_path}/tables")
    gate.start(stream, control.registry(spark), KEY, store, f"file://{tmp_path}/checkpoint").awaitTermination()
    got = {r["ordinal"]: r["reason"] for r in store.read("outcomes").collect()}
    assert got == {0: "contract_and_identity_passed", 1: "invalid_json", 2: "invalid_json", 3: "invalid_json", 4: "prohibited_fields:pin", 5: "identity_payload_conflict", 6: "exact_event_replay", 7: "invalid_json"}
    assert sorted(r["ordinal"] for r in store.read("bronze").collect()) == [0, 5, 6]
    assert [str(r["event_date"]) for r in store.read("accepted_event").collect()] == ["2026-01-01"]
    kept = {r["ordinal"]: r["payload"] for r in store.read("quarantine").collect()}
    assert json.loads(kept[1])["unreadable_bytes"] == 200_000 and "@" not in kept[5].lower() and kept[7] is None


def test_a_crashed_batch_is_written_once(spark, tmp_path, monkeypatch):
    lines(spark, BASE, BASE | {"event_id": "e-2"}, BASE).coalesce(1).write.parquet(f"file://{tmp_path}/in")
    store = TableStore(spark, f"file://{tmp_path}/tables")
    run = lambda: gate.start(spark.readStream.schema(gate.ARRIVAL).parquet(f"file://{tmp_path}/in"), control.registry(spark), KEY, store, f"file://{tmp_path}/checkpoint").awaitTermination()

    def crash(self, change):
        raise OSError("crash before the pointer")

    with monkeypatch.context() as patched:
        patched.setattr(TableStore, "_publish", crash)
        with pytest.raises(Exception, match="crash before the pointer"):
            run()
    assert not store.has("outcomes") and not store.done("batch-0")
    run()
    run()
    assert sorted(r["outcome"] for r in store.read("outcomes").collect()) == ["ACCEPTED", "ACCEPTED", "DUPLICATE"]
    assert store.read("seen_event").count() == 2 and store.done("batch-0")


def test_a_second_run_renews_only_what_it_touches(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/t")
    first = generator.arrivals(spark, 200)
    workflow.process(store, first, control.registry(spark), KEY, "one")
    n = store.read("ledger_entry").count()
    late = BASE | {"event_id": "late", "transaction_id": "txn-0000000001", "transaction_version": 9, "event_type": "refund", "received_at": "2026-03-01T00:00:00Z"}
    workflow.process(store, lines(spark, late), control.registry(spark), KEY, "two")
    assert store.read("ledger_entry").count() == n
    bad = {r["transaction_id"] for r in store.read("business_exception").collect()}
    assert bad == {"txn-0000000001"} and store.read("payment_state").filter(F.col("transaction_id").isin(*bad)).isEmpty()
    accepted = store.read("accepted_event").drop("event_date")
    rebuilt = lifecycle.current_state(lifecycle.assess(accepted))
    assert rebuilt.exceptAll(store.read("payment_state")).isEmpty() and rebuilt.count() == store.read("payment_state").count()
    before = store.n_directories("posted_event")
    workflow.process(store, first, control.registry(spark), KEY, "replay")
    assert store.n_directories("posted_event") == before and store.read("ledger_entry").count() == n
    workflow.project_date(store, "2026-01-01", "by-date")
    assert rebuilt.exceptAll(store.read("payment_state")).isEmpty() and store.read("ledger_entry").count() == n
    assert {r["run_id"]: r["status"] for r in workflow.journal(store).collect()} == {"one": "SUCCEEDED", "two": "SUCCEEDED", "replay": "SUCCEEDED", "by-date": "SUCCEEDED"}


def test_store_names_and_whole_states(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FULL_EVERY", 3)
    store = TableStore(spark, f"file://{tmp_path}/t")
    for name in ("a b", "../x", "a;drop", ""):
        with pytest.raises(ValueError, match="not_a_table_name"), store.commit(f"bad{name}") as change:
            change.create(name, spark.range(1).schema)
    assert store.bootstrap({"k": spark.range(1).schema}) == ["k"] and store.bootstrap({"k": spark.range(1).schema}) == []
    for i in range(7):
        with store.commit(f"r{i}", {"p": ["id"]}) as change:
            change.append("k", spark.range(i, i + 1))
            change.append("p", spark.range(2).withColumn("v", F.lit(i)))
    assert sorted(r["id"] for r in store.read("k").collect()) == list(range(7)) and store.read("p").count() == 14
    assert store.read("p").columns == ["v", "id"] and store.done("r3") and not store.done("r9")
    assert store.read("k", 3).count() == 3
    store.compact("p", 1)
    assert store.read("p").count() == 14 and store.n_directories("p") == 1


def test_shipped_files_of_rules_and_sources(spark, tmp_path):
    (tmp_path / "rules.json").write_text(json.dumps({"version": 2, "currency_unit": "minor", "rules": {k: [{"account": a, "multiplier": m} for a, m in v] for k, v in vocabulary.POSTING_RULES.items()}}))
    rules = posting.rules_frame(spark, *control.posting_rules(spark, f"file://{tmp_path}/rules.json"))
    assert rules.count() == 6 and {r["version"] for r in rules.collect()} == {2}
    (tmp_path / "sources.json").write_text(json.dumps({"families": [{"family": "f", "instances": 2, "mode": "stream", "contract": "payment_event", "owner": "o", "freshness_minutes": 5}]}))
    assert control.registry(spark, f"file://{tmp_path}/sources.json").count() == 2


def test_entry_points(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
