"""Tables in buckets: what a run reads and writes follows the payments that it touches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from paytrail.operators import lifecycle, posting
from paytrail.plans import marts, workflow
from paytrail.sources import control, generator
from paytrail.sources.tables import BUCKET, CommitConflict, TableStore, bucket_of

from paytrail.vocabulary import POSTING_RULES

from .test_payments import BASE, KEY, lines

RENEWED = ("payment_state", "business_exception")
LAYOUT = {"bucket_by": {"a": ("k", 8)}}


def frame(spark, *ks, v="v"):
    return spark.createDataFrame([(k, f"{v}{k}") for k in ks], "k int, v string")


def buckets_in(store, table):
    """{bucket: its directories} of a table."""
    found = {}
    for p in store._current()["tables"][table]:
        found.setdefault(int(p.rsplit("=", 1)[-1]), set()).add(p)
    return found


def test_a_run_rewrites_and_reads_the_buckets_of_its_payments_only(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/t")
    workflow.process(store, generator.arrivals(spark, 300), control.registry(spark), KEY, "one")
    before = {t: buckets_in(store, t) for t in (*RENEWED, "posted_event", "ledger_entry")}
    assert len(before["payment_state"]) == workflow.BUCKETS
    txn = "txn-0000000001"
    own = spark.createDataFrame([(txn,)], "transaction_id string").select(bucket_of("transaction_id", workflow.BUCKETS)).first()[0]
    late = BASE | {"event_id": "late", "transaction_id": txn, "transaction_version": 9, "event_type": "refund", "received_at": "2026-03-01T00:00:00Z"}
    read = []
    whole = TableStore._frame

    def noted(self, state, table, buckets=None):
        rows = whole(self, state, table, buckets)
        if table in workflow.BY_KEY and not table.startswith("ledger_daily"):
            read.append((table, {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in rows.inputFiles() if BUCKET in f} if buckets else None))
        return rows

    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(TableStore, "_frame", noted)
        workflow.process(store, lines(spark, late), control.registry(spark), KEY, "two")
    assert all(found is not None and len(found) <= 1 for _, found in read) and {t for t, _ in read} >= {"accepted_event", "payment_state", "ledger_entry", "seen_event"}
    for table in (*RENEWED, "posted_event", "ledger_entry"):
        after = buckets_in(store, table)
        changed = {b for b in after.keys() | before[table].keys() if after.get(b) != before[table].get(b)}
        assert changed <= {own}, table
    assert store.read("business_exception").filter(F.col("transaction_id") == txn).count() == 3


def same(a, b):
    assert a.select(b.columns).exceptAll(b).isEmpty() and b.exceptAll(a.select(b.columns)).isEmpty()


def test_daily_sums_follow_late_events_that_spoil_and_heal_payments(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/t")
    event = lambda v, kind, amount=100, txn="t-1", day=1: BASE | {"event_id": f"{txn}-{v}", "transaction_id": txn, "transaction_version": v, "event_type": kind, "amount_minor": amount, "event_time": f"2026-01-{day:02d}T00:0{v}:00Z", "received_at": f"2026-01-{day:02d}T00:0{v}:30Z"}
    runs = [
        [event(1, "authorization"), event(2, "capture"), event(1, "authorization", txn="t-2"), event(2, "capture", 70, txn="t-2"), event(1, "authorization", txn="t-3")],
        [event(4, "refund", 10, day=2)],  # a gap: t-1 is out
        [event(3, "refund", 20, day=2), event(2, "capture", 30, txn="t-3", day=3)],  # the gap is filled: t-1 is back
        [event(5, "refund", 900, txn="t-2", day=4)],
    ]
    for i, events in enumerate(runs):
        workflow.process(store, lines(spark, *events), control.registry(spark), KEY, f"run{i}")
        rebuilt = marts.ledger_daily(store.read("ledger_entry"), store.read("business_exception"))
        same(store.read("ledger_daily"), rebuilt)
        state = lifecycle.current_state(lifecycle.assess(store.read("accepted_event").drop("event_date")))
        same(store.read("payment_state"), state)
    assert {r["transaction_id"] for r in store.read("business_exception").collect()} == {"t-2"}


def test_commits_over_different_buckets_both_come_about(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/t")
    with store.commit("start", **LAYOUT) as change:
        change.append("a", frame(spark, *range(40)))
    assert len(buckets_in(store, "a")) == 8 and store.read("a").columns == ["k", "v"]

    def renew(change, k):
        one = frame(spark, k, v="new")
        buckets = change.buckets("a", one)
        change.renew_buckets("a", buckets, change.read_buckets("a", buckets).filter(F.col("k") != k).unionByName(one))

    home = {r["k"]: r["b"] for r in frame(spark, *range(40)).select("k", bucket_of("k", 8).alias("b")).collect()}
    far = next(k for k in home if home[k] != home[0])
    near = next(k for k in home if home[k] == home[0] and k != 0)
    with store.commit("outer") as outer:
        renew(outer, 0)
        store.retried("inner", lambda change: renew(change, far))
    assert {r["k"] for r in store.read("a").filter("v LIKE 'new%'").collect()} == {0, far} and store.read("a").count() == 40
    with pytest.raises(CommitConflict), store.commit("outer2") as outer:
        renew(outer, 0)
        store.retried("inner2", lambda change: renew(change, near))
    with pytest.raises(CommitConflict), store.commit("outer3") as outer:
        outer.append("b", outer.read("a"))
        store.retried("inner3", lambda change: renew(change, far))
    with store.commit("outer4") as outer:
        renew(outer, 0)
        store.retried("inner4", lambda change: change.append("a", frame(spark, far, v="again")))
    store.compact("a", 1)
    assert store.read("a").count() == 41 and all(len(p) == 1 for p in buckets_in(store, "a").values())


def test_a_transaction_with_very_many_events_is_counted_in_two_stages(spark):
    hot = spark.range(0, 300_000, 1, 8).selectExpr("'hot' AS transaction_id", "concat('e', id) AS event_id", "id + 1 AS transaction_version", "IF(id = 0, 'authorization', 'capture') AS event_type", "CAST(IF(id = 0, 900000, 1) AS LONG) AS amount_minor", "'INR' AS currency", "'p' AS processor_id", "'m' AS merchant_id")
    assessed = lifecycle.assess(hot)
    plan = assessed._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "transaction_version" in plan.split("Exchange hashpartitioning(transaction_id", 2)[-1]
    got = assessed.first()
    assert (got["n_events"], got["n_versions"], got["business_error"], got["captured_minor"]) == (300_000, 300_000, None, 299_999)
    twice = hot.unionByName(hot.filter("transaction_version = 7").withColumn("event_id", F.lit("x")))
    assert lifecycle.assess(twice).first()["business_error"] == "transaction_version_conflict"


@pytest.mark.parametrize(("line", "why"), [(("a", 1.5), "multiplier"), (("a", True), "multiplier"), (("a", "1"), "multiplier"), ((None, 1), "account"), (("  ", 1), "account"), ((7, 1), "account"), (("a", 1), "unbalanced")])
def test_posting_rules_of_wrong_types_are_refused(line, why):
    posting.check_rules(POSTING_RULES, 1, "minor")
    with pytest.raises(ValueError, match=why):
        posting.check_rules(POSTING_RULES | {"capture": [line]}, 1, "minor")
