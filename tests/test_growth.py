"""What a query does for a row, and what it leaves on disk, as its plan and the shared folder tell."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from paytrail import catalog
from paytrail.functions import secrets
from paytrail.operators import posting
from paytrail.plans import marts, workflow
from paytrail.sources.tables import Change, TableStore

from .test_payments import SAMPLE, lines


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_redaction_reads_a_text_once(spark):
    """F1."""
    assert plan(lines(spark, "{}").select(secrets.redacted(F.col("value")))).count("parseJson(") == 1


def test_arrivals_are_not_written_first(spark):
    """F9 to F13, F19: neither the derived events nor the texts are dealt out and written before they are read."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(folder))
    for name in ("cdc_unwrap", "prohibited_key_scan", "customer_token_hmac"):
        frame = catalog.queries()[name](spark, SAMPLE)
        assert "RoundRobin" not in plan(frame) and "REPARTITION" not in plan(frame)
    assert set(os.listdir(folder)) == before


def test_payments_are_judged_without_another_exchange(spark):
    """events are exchanged with orders and lines, once; the mart reads what was judged."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(catalog.queries()["txn_assessment"](spark, SAMPLE)).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("dim_payment_current", "dq_no_invalid_current"):
        assert "l_linenumber" not in plan(catalog.queries()[name](spark, SAMPLE))


def test_expected_settlement_is_summed_up_once(spark):
    """evidence and comparison read what was summed up, not the events."""
    for name in ("overwrite_where", "fct_settlement_exception", "settlement_duplicate_keys"):
        assert "l_linenumber" not in plan(catalog.queries()[name](spark, SAMPLE))


def test_a_run_exchanges_the_history_of_its_payments_once(spark):
    """F16: all that a run writes comes of one exchange by transaction; rows aren't dealt out again for a table's few buckets."""
    staged = {}
    whole = Change._stage

    def noted(self, table, rows):
        staged.setdefault(table, []).append(plan(rows))
        return whole(self, table, rows)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pytest.MonkeyPatch.context() as patched:
            patched.setattr(Change, "_stage", noted)
            catalog.queries()["incremental_ledger_daily"](spark, SAMPLE)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all(p.count("Exchange hashpartitioning(transaction_id") == 2 and "Join" not in p for p in staged["run_judged"])  # the second one for the distinct payments
    assert all("Exchange hashpartitioning" not in p for t in ("posted_event", "ledger_entry") for p in staged[t])


def test_a_run_adds_lines_that_the_ledger_lacks_and_no_others(spark, tmp_path):
    """F16: an event that isn't noted as posted, with one of its two lines in the ledger, gets the other one only."""
    store = TableStore(spark, f"file://{tmp_path}/t")
    store.bootstrap(workflow.TABLES, bucket_by=workflow.LAYOUT["bucket_by"])
    rules = posting.rules_frame(spark)
    rows = [(f"e{v}", "t", v, kind, amount) for v, kind, amount in ((1, "authorization", 9), (2, "capture", 5), (3, "refund", 2))]
    made = spark.createDataFrame(rows, "event_id string, transaction_id string, transaction_version long, event_type string, amount_minor long")
    events = made.selectExpr(*made.columns, "'s' source_id", "'p' processor_id", "'m' merchant_id", "'INR' currency", "TIMESTAMP '2026-01-01' event_time", "TIMESTAMP '2026-01-01' received_at", "CAST(NULL AS STRING) customer_token", "DATE '2026-01-01' event_date")
    accepted = events.select(workflow.TABLES["accepted_event"].fieldNames())
    with store.commit("one") as change:
        change.append("ledger_entry", posting.post(events, rules).filter("entry_id = 'e2:1'"))
        change.append("accepted_event", accepted)
        workflow.project(change, accepted, rules)
    assert sorted(r["entry_id"] for r in store.read("ledger_entry").collect()) == ["e2:1", "e2:2", "e3:1", "e3:2"]
    assert sorted(r["event_id"] for r in store.read("posted_event").collect()) == ["e2", "e3"]


def test_orphans_are_found_by_identifiers_alone(spark):
    """events are derived once and lines aren't exchanged; lines without an event, or an identifier, are all there."""
    own = plan(catalog.queries()["dq_relationships"](spark, SAMPLE))
    assert "l_linenumber" not in own and "Exchange hashpartitioning" not in own
    lines = spark.createDataFrame([("e1", 1), ("e1", 2), ("e2", 3), ("e3", 4), ("e3", 5), (None, 6)], "event_id string, n int")
    accepted = spark.createDataFrame([("e1",), ("e1",), ("e4",), (None,)], "event_id string")
    found = marts.orphans(lines, accepted)
    assert found.columns == ["event_id", "n"] and sorted(r["n"] for r in found.collect()) == [3, 4, 5, 6]
    assert marts.orphans(lines, lines.filter("event_id IS NOT NULL")).collect() == lines.filter("n = 6").collect()
