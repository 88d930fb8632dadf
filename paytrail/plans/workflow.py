"""Runs over the table store: taking arrivals in, and closing a business date.

A run's tables are published by one commit, so that a reader sees all of a run or
nothing; a journal tells how each run went.  Projections follow the payments that a run
touches: their whole history is judged again, their state and exceptions
replace what was there, and events and ledger lines that weren't posted before are
added.  What a late event makes invalid stays posted and is left out of marts by its exception.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import contract, identity, lifecycle, merging, posting, settlement
from ..sources.files import Files
from ..sources.tables import Change, CommitConflict, TableStore
from ..vocabulary import ENTRY, EVENT, POSTING_RULES, SETTLEMENT, SETTLEMENT_KEY, STATE
from . import marts

DAILY = {"accepted_event": ["event_date"]}
#: Buckets of the tables that a run looks up or renews by key; a bucket should be some 100 MB at the size that is expected.
BUCKETS = 8
BY_KEY = {"seen_event": "event_id"} | dict.fromkeys(("accepted_event", "payment_state", "business_exception", "posted_event", "ledger_entry"), "transaction_id")
BY_KEY["ledger_daily"] = "business_date"
LAYOUT = {"partition_by": DAILY, "bucket_by": {table: (key, BUCKETS) for table, key in BY_KEY.items()}}
JOURNAL = T.StructType().add("run_id", "string").add("status", "string").add("at", "timestamp").add("failure_reason", "string")
AMOUNTS = T.StructType([T.StructField(c, T.LongType()) for c in lifecycle.AMOUNTS])
#: The tables that a new store begins with.
TABLES = {
    "accepted_event": T.StructType([*EVENT.fields, T.StructField("event_date", T.DateType())]),
    "seen_event": T.StructType().add("event_id", "string").add("fingerprint", "string"),
    "quarantine": T.StructType().add("ordinal", "long").add("reason", "string").add("payload", "string"),
    "run_outcome": T.StructType().add("ordinal", "long").add("event_id", "string").add("outcome", "string").add("reason", "string").add("run_id", "string"),
    "run_journal": JOURNAL,
    "payment_state": STATE,
    "business_exception": T.StructType([*EVENT.fields, *AMOUNTS.fields, T.StructField("business_error", T.StringType())]),
    "posted_event": EVENT,
    "ledger_entry": ENTRY,
    "ledger_daily": T.StructType().add("business_date", "date").add("processor_id", "string").add("merchant_id", "string").add("currency", "string").add("account", "string").add("entry_count", "long").add("signed_minor", "long"),
}


class Failpoint(RuntimeError):
    """Raised by tests where a crash is wanted."""


def note(store: TableStore, run: str, status: str, reason: str | None = None) -> None:
    row = store.spark.createDataFrame([(run, status, None, reason)], JOURNAL).withColumn("at", F.current_timestamp())
    with store.commit(f"journal-{uuid.uuid4().hex}") as change:
        change.append("run_journal", row)


@contextmanager
def journaled(store: TableStore, run: str):
    """Notes STARTED, and FAILED with the reason if what follows fails; success is noted with the run's own commit."""
    note(store, run, "STARTED")
    try:
        yield
    except Exception as error:
        note(store, run, "FAILED", str(error)[:1000])
        raise


def journal(store: TableStore) -> DataFrame:
    """(run_id, status, at, failure_reason): how each run stands."""
    latest = F.max_by(F.struct("status", "at", "failure_reason"), F.struct("at", F.col("status") != "STARTED"))
    return store.read("run_journal").groupBy("run_id").agg(latest.alias("s")).select("run_id", "s.*")


def project(change: Change, touched: DataFrame, rules: DataFrame) -> None:
    """Judges the payments in touched (transaction_id) anew by all of their events, and renews what is told of them.

    Only the buckets that those payments are in are read and written.
    """
    buckets = change.buckets("payment_state", touched)
    own = touched.select("transaction_id").distinct()
    lines = change.read_buckets("ledger_entry", buckets)
    change.replace("run_judged", judged(change, buckets, own, lines))  # once; all else comes of it without another exchange
    events = change.read("run_judged")
    latest = events.filter("state_rank = 1").withColumn("latest", F.struct("event_id", "currency", "processor_id", "merchant_id"))
    wrong = events.filter("business_error IS NOT NULL").select(*EVENT.fieldNames(), *lifecycle.AMOUNTS, "business_error")
    renewed = {"payment_state": lifecycle.current_state(latest), "business_exception": wrong}
    change.renew_together(buckets, **{t: merging.renewed(change.read_buckets(t, buckets), rows, own, "transaction_id") for t, rows in renewed.items()})
    due = events.filter("is_due")
    new = due.select(*EVENT.fieldNames())
    posting.require_balanced(posting.post(new, rules))
    added = posting.post(new, rules)
    again = due.filter("has_lines").select(*EVENT.fieldNames())
    if not again.isEmpty():  # lines of events that weren't noted as posted
        added = posting.post(due.filter("NOT has_lines").select(*EVENT.fieldNames()), rules).unionByName(merging.new_rows(lines, posting.post(again, rules), ["entry_id"]))
    # The lines that there were before, whose payments became exceptions or no longer are.
    turned = latest.withColumn("times", F.col("was_bad").cast("long") - F.col("business_error").isNotNull().cast("long")).filter("times <> 0")
    change.replace("run_turned", marts.daily_parts(lines.join(turned.select("transaction_id", "times"), "transaction_id"), F.col("times")))
    keep_ledger_daily(change, marts.daily_parts(added).unionByName(change.read("run_turned")))
    change.together(posted_event=new, ledger_entry=added)
    change.drop("run_judged", "run_turned")


def judged(change: Change, buckets: list[int], own: DataFrame, lines: DataFrame) -> DataFrame:
    """Every event of the payments in own, with their figures, what is wrong with them, and what is known of them in the store.

    is_due tells monetary events of valid payments that weren't posted (of rows with the same identifier the one of the
    least values, as identifiers are of one payment), has_lines those with ledger lines, was_bad payments that were exceptions.
    All is exchanged by transaction once: what is known of them comes as rows beside the events, since joins would exchange those again.
    """
    beside = lambda rows, kind, *ids: rows.select("transaction_id", *ids, F.lit(kind).alias("kind"))
    # What is mostly the same in all of a payment's events comes first: rows that begin alike pack better.
    varying = ("transaction_version", "event_type", "amount_minor", "event_id")
    alike = [c for c in EVENT.fieldNames() if c not in varying]
    rows = change.read_buckets("accepted_event", buckets).select(*alike, F.lit(None).cast("string").alias("kind"), *varying)
    for more in (
        beside(own, "touched"),
        beside(change.read_buckets("posted_event", buckets), "posted", "event_id"),
        beside(lines, "line", "event_id"),
        beside(change.read_buckets("business_exception", buckets), "bad"),
    ):
        rows = rows.unionByName(more, allowMissingColumns=True)
    payment, event = Window.partitionBy("transaction_id"), Window.partitionBy("transaction_id", "event_id")
    in_order = event.orderBy(*(c for c in ("kind", *EVENT.fieldNames()) if c not in ("transaction_id", "event_id")))  # events, without a kind, first
    there_is = lambda kind, of: F.coalesce(F.max(F.col("kind") == kind).over(of), F.lit(False))
    told = {"copy": F.row_number().over(in_order), "was_posted": there_is("posted", event), "has_lines": there_is("line", event), "was_bad": there_is("bad", payment), "touched": there_is("touched", payment)}
    history = rows.withColumns(told).filter("kind IS NULL AND touched")
    due = posting.due(F.col("event_type"), F.col("business_error")) & (F.col("copy") == 1) & ~F.col("was_posted")
    shown = F.col("business_error").isNotNull() | (F.col("state_rank") == 1)  # elsewhere nobody asks for the payment's figures
    figures = [F.when(shown, F.col(c)).alias(c) for c in (*lifecycle.AMOUNTS, "max_version")]
    return lifecycle.assess_by_window(history).select(*EVENT.fieldNames(), *figures, "business_error", "state_rank", due.alias("is_due"), "has_lines", "was_bad")


def keep_ledger_daily(change: Change, changes: DataFrame) -> None:
    """Adds changes of daily sums, summed up or not, to those that are kept; only the buckets of their days are read and written."""
    days = change.buckets("ledger_daily", changes)
    if days:
        change.renew_buckets("ledger_daily", days, marts.summed_daily(change.read_buckets("ledger_daily", days).unionByName(changes)))


def project_date(store: TableStore, business_date: str, run: str, rules: DataFrame | None = None) -> None:
    """Projects the payments that have an event on the date, with their whole history."""
    rules = posting.rules_frame(store.spark, POSTING_RULES) if rules is None else rules
    with journaled(store, run), store.commit(run) as change:
        day = F.to_date(F.lit(business_date))
        project(change, change.read("accepted_event").filter(F.col("event_date") == day).select("transaction_id"), rules)
        change.append("run_journal", succeeded(store.spark, run))


def succeeded(spark: SparkSession, run: str) -> DataFrame:
    return spark.createDataFrame([(run, "SUCCEEDED", None, None)], JOURNAL).withColumn("at", F.current_timestamp())


def process(store: TableStore, arrivals: DataFrame, registry: DataFrame, key: bytes, run: str, rules: DataFrame | None = None, failpoint: str | None = None) -> None:
    """Takes in arrivals (ordinal, value) as one run: identities, accepted events, quarantine, outcomes, projections."""
    spark = store.spark
    rules = posting.rules_frame(spark, POSTING_RULES) if rules is None else rules
    store.bootstrap(TABLES, **LAYOUT)
    with journaled(store, run), store.commit(run, **LAYOUT) as change:
        # Written once, and read for each of the tables that come of it.
        change.replace("run_checked", contract.check(arrivals, registry, key))
        checked = change.read("run_checked")
        valid = checked.filter("reason IS NULL").drop("reason")
        change.replace("run_judged", identity.classify(valid, change.read_buckets("seen_event", change.buckets("seen_event", valid))))
        judged = change.read("run_judged")
        refused = checked.filter("reason IS NOT NULL").withColumn("outcome", F.lit("QUARANTINED"))
        outcomes = refused.select("ordinal", "event_id", "outcome", "reason").unionByName(judged.select("ordinal", "event_id", "outcome", "reason"))
        new = judged.filter("outcome = 'ACCEPTED'").select(*contract.EVENT_COLUMNS).withColumn("event_date", F.to_date("event_time"))
        change.together(
            run_outcome=outcomes.withColumn("run_id", F.lit(run)),
            quarantine=contract.quarantine(refused.select("ordinal", "reason", "value")).unionByName(contract.conflicts(judged)),
            seen_event=identity.newly_seen(judged),
            accepted_event=new,
        )
        if failpoint == "after_ingest":
            raise Failpoint(failpoint)
        if not new.isEmpty():
            project(change, new, rules)
            change.drop("settlement_exception")  # a reconciliation holds only for the postings that it saw
        change.append("run_journal", succeeded(spark, run))
        change.drop("run_checked", "run_judged")
        if failpoint == "before_commit":
            raise Failpoint(failpoint)


def read_evidence(spark: SparkSession, path: str) -> DataFrame:
    """Settlement rows; what doesn't fit the schema is null and fails the contract gate."""
    return spark.read.schema(SETTLEMENT).json(path)


def validate_evidence(records: DataFrame, manifest: dict, business_date: str) -> DataFrame:
    """The records, if nothing is wrong with the delivery; the error names all that is."""
    if faults := settlement.verdict(records, manifest, business_date):
        raise RuntimeError(f"settlement_evidence_refused:{business_date}:{','.join(faults)}")
    return records


def reconcile(store: TableStore, evidence: DataFrame, business_date: str, run: str, strict: bool = True) -> dict:
    """Compares a date's ledger with its evidence and keeps both; then a shut gate stops the workflow, if strict."""
    day = F.to_date(F.lit(business_date))
    actual = evidence.filter(F.col("business_date") == day).select(*SETTLEMENT_KEY, "amount_minor")

    def body(change: Change) -> None:
        ledger = marts.excluding(change.read("ledger_entry").filter(F.to_date("event_time") == day), change.read("business_exception"))
        found = settlement.exceptions(settlement.compare(settlement.expected(ledger), actual))
        change.overwrite_where("settlement_evidence", actual, F.col("business_date") == day)
        change.overwrite_where("settlement_exception", found, F.col("business_date") == day)

    store.retried(run, body)
    gate = settlement.gate(store.read("settlement_exception").filter(F.col("business_date") == day)).first().asDict()
    if strict and not gate["gate_open"]:
        raise RuntimeError(f"settlement_gate_shut:{business_date}:{gate['exception_count']} differences of {gate['absolute_delta_minor']} in all")
    return gate


def publish(store: TableStore, root: str, business_date: str, revision: int, sha256: str) -> str:
    """Marks a reconciled date, if this revision is still the registered one: RECONCILED or SUPERSEDED."""
    files = Files(store.spark)
    files.write(f"{root}/gates/business_date={business_date}/revision={revision}/sha256={sha256}/SETTLEMENT_RECONCILED.json", '{"gate":"SETTLEMENT_RECONCILED"}')
    own = (F.col("business_date") == business_date) & (F.col("revision") == revision) & (F.col("sha256") == sha256)
    if store.read("settlement_publication").filter(own).isEmpty():
        return "SUPERSEDED"
    try:
        # Conditional on the register as it is read here: a revision that comes in between wins.
        with store.commit(f"publish-{business_date}-{revision}-{sha256[:16]}") as change:
            row = change.read("settlement_publication").filter(own)
            if row.isEmpty():
                raise CommitConflict("superseded")
            change.upsert("settlement_publication", row.withColumn("status", F.lit("RECONCILED")), ["business_date"])
    except CommitConflict:
        if store.read("settlement_publication").filter(own).isEmpty():
            return "SUPERSEDED"
        raise
    return "RECONCILED"


def require_reconciled(store: TableStore, business_date: str) -> None:
    """The marts' sensor."""
    if not store.has("settlement_publication") or store.read("settlement_publication").filter((F.col("business_date") == business_date) & (F.col("status") == "RECONCILED")).isEmpty():
        raise RuntimeError(f"business date not reconciled:{business_date}")


def build_marts(store: TableStore, business_date: str, run: str, now: str | None = None) -> dict[str, str]:
    """Waits for no one: stops unless the date is reconciled and no source table is stale; then writes the marts.

    now is an ISO time to judge freshness by, the clock's if not given.  The answer is the
    verdict on each source table.
    """
    require_reconciled(store, business_date)
    views_of = ("accepted_event", "payment_state", "ledger_entry", "business_exception", "settlement_exception")
    views = marts.staging({t: store.read(t) for t in views_of})
    fresh = marts.source_freshness(views, now)
    verdicts = {r["source_table"]: r["verdict"] for r in fresh.collect()}
    if late := sorted(t for t, v in verdicts.items() if v == "error"):
        raise RuntimeError("stale_sources:" + ",".join(late))

    def body(change: Change) -> None:
        exceptions = marts.staging({t: change.read(t) for t in views_of})
        change.together(
            replace=True,
            dim_payment_current=marts.payment_current(change.read("payment_state"), exceptions["stg_business_exception"]),
            fct_ledger_daily=change.read("ledger_daily"),  # kept up by each run's changes
            fct_settlement_exception=exceptions["stg_settlement_exception"],
        )

    store.retried(run, body)
    return verdicts
