"""Registered queries over the payment tables, with SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .functions import secrets
from .operators import contract, identity, lifecycle, merging, posting, revisions, settlement
from .plans import marts, workflow
from .sources import control, generator, sample
from .sources.shared import shared_folder, written
from .sources.tables import TableStore

Query = Callable[[SparkSession, str], DataFrame]
#: The key of the sample queries; real runs read theirs from a secret store.
SAMPLE_KEY = b"sample-key-for-registered-queries-only"
#: A date and a payment that every sample size has.
TRACE_ID = "txn-1"
TOUCHED_DATE = "1995-03-15"


class Inputs:
    """Frames of one query, made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def events(self) -> DataFrame:
        return sample.payment_events(self.spark, self.sf_dir).drop("k", "seq", "custkey")

    def assessed(self) -> DataFrame:
        return lifecycle.assess(self.events())

    def state(self) -> DataFrame:
        return lifecycle.current_state(self.assessed())

    def exceptions(self) -> DataFrame:
        return lifecycle.business_exceptions(self.events(), self.assessed())

    @cached_property
    def judged(self) -> DataFrame:
        """Assessed payments, a row for each, written once for queries that read both what they are and what is wrong with them."""
        return written(self.assessed(), "assessed")

    def current(self) -> tuple[DataFrame, DataFrame]:
        """Payments' mart, and the transactions of all exceptions, a row for each event, which are written once."""
        told = written(lifecycle.business_exceptions(self.events(), self.judged).select("transaction_id"), "exceptions")
        return marts.payment_current(lifecycle.current_state(self.judged), told), told

    def posted(self) -> DataFrame:
        return posting.postable(self.events(), self.assessed())

    def ledger(self) -> DataFrame:
        return posting.post(self.posted(), posting.rules_frame(self.spark))

    def expected(self) -> DataFrame:
        return settlement.expected(self.ledger())

    @cached_property
    def due(self) -> DataFrame:
        """What is expected, a row for each date, processor and currency: summed up once and written, since evidence and comparison read it several times."""
        return written(self.expected(), "expected")

    def evidence(self) -> DataFrame:
        return sample.settlement_evidence(self.due)

    def compared(self) -> DataFrame:
        return settlement.compare(self.due, self.evidence())

    def settlement_exceptions(self) -> DataFrame:
        return settlement.exceptions(self.compared())

    def checked(self) -> DataFrame:
        return contract.check(sample.raw_arrivals(self.spark, self.sf_dir), control.registry(self.spark), SAMPLE_KEY)

    def outcomes(self) -> DataFrame:
        """(ordinal, event_id, outcome, reason) of every arrival; the gate runs once, and its verdicts are written without payloads."""
        checked = written(self.checked().select("ordinal", "event_id", "fingerprint", "reason"), "checked")
        refused = checked.filter("reason IS NOT NULL").select("ordinal", "event_id", F.lit("QUARANTINED").alias("outcome"), "reason")
        valid = checked.filter("reason IS NULL").drop("reason")
        return refused.unionByName(identity.classify(valid).select("ordinal", "event_id", "outcome", "reason"))


def _over(f: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(Inputs(spark, sf_dir))


ASSESSED = (
    "transaction_id n_events min_version max_version n_authorizations authorized_minor captured_minor refunded_minor chargeback_minor first_authorization first_capture first_reversal business_error"
).split()


def _window_form(i: Inputs) -> DataFrame:
    return lifecycle.assess_by_window(i.events()).filter("state_rank = 1").select(*ASSESSED)


def _registry_decisions(i: Inputs) -> DataFrame:
    """Deliveries for every business date of the events, of which some are registered already, higher, lower or with other content."""
    days = i.events().select(F.to_date("event_time").alias("d")).distinct().select(F.col("d").cast("string").alias("business_date"), F.dayofmonth("d").alias("n"))
    sha = lambda more: F.sha2(F.concat("business_date", more), 256).alias("sha256")
    stored = days.filter("n % 7 <> 0").select("business_date", (2 + F.col("n") % 2).cast("int").alias("revision"), sha(F.lit("")))
    new = days.select("business_date", (1 + F.col("n") % 4).cast("int").alias("revision"), sha(F.when(F.col("n") % 5 == 0, "x").otherwise("")))
    return revisions.decide(stored, new)


def _registry(i: Inputs) -> DataFrame:
    """Every registered source and the valid events that came of it."""
    came = i.checked().filter("reason IS NULL").groupBy("source_id").agg(F.count("*").alias("n_valid"))
    return control.registry(i.spark).join(came, "source_id", "left").fillna(0, ["n_valid"])


def _rules(i: Inputs) -> DataFrame:
    """Every posting rule and the events that it posted."""
    used = i.posted().groupBy("event_type").agg(F.count("*").alias("n_posted"))
    return posting.rules_frame(i.spark).join(used, "event_type", "left").fillna(0, ["n_posted"])


def _halves(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """State of two overlapping sets of payments, the second with other statuses."""
    state = i.state().select("transaction_id", "status", "captured_minor")
    n = F.substring_index("transaction_id", "-", -1).cast("long")
    return state.filter(n % 3 != 0), state.filter(n % 2 == 0).withColumn("status", F.concat(F.lit("NEW_"), "status"))


def _overwritten(i: Inputs) -> DataFrame:
    found = i.settlement_exceptions()
    new = found.filter(F.dayofmonth("business_date") == 10).limit(0)
    return merging.overwrite_where(found, new, F.dayofmonth("business_date") == 10)


def _injected(i: Inputs) -> DataFrame:
    """Ledger lines of which every seventh payment lost its second line."""
    n = F.substring_index("transaction_id", "-", -1).cast("long")
    return posting.unbalanced(i.ledger().filter(~((n % 7 == 0) & F.endswith("entry_id", F.lit(":2")))))


def _orphans(i: Inputs) -> DataFrame:
    """The events are derived once, judged in that same order, and written with what tells the posted ones; lines and events are read from there."""
    events = i.events()
    judged = lifecycle.assess_by_window(events).select(*events.columns, posting.due(F.col("event_type"), F.col("business_error")).alias("is_due"))
    told = written(judged, "told")
    ledger = posting.post(told.filter("is_due").drop("is_due"), posting.rules_frame(i.spark))
    return marts.orphans(ledger, told)


def _cdc(i: Inputs) -> DataFrame:
    rows = contract.unwrap(sample.cdc_arrivals(i.spark, i.sf_dir))
    event_id = F.when(F.col("unwrap_reason").isNull(), F.try_variant_get("payload", "$.event_id", "string"))
    return rows.select("ordinal", "unwrap_reason", event_id.alias("event_id"))


def _broken_evidence(i: Inputs) -> DataFrame:
    e = i.evidence()
    day, third = F.dayofmonth("business_date"), F.col("processor_id") == "processor-03"
    return e.withColumns(
        {
            "currency": F.when((day == 2) & third, None).when((day == 3) & third, "JPY").otherwise(F.col("currency")),
            "amount_minor": F.when((day == 4) & third, None).otherwise(F.col("amount_minor")),
            "schema_version": F.when((day == 5) & third, "2.0").otherwise(F.col("schema_version")),
        }
    )


def _twice(i: Inputs) -> DataFrame:
    e = i.evidence()
    return e.unionByName(e.filter(F.dayofmonth("business_date") == 6))


def _redactions(i: Inputs) -> DataFrame:
    return sample.nested_arrivals(i.spark, i.sf_dir).select("ordinal", secrets.redacted(F.col("value")).alias("payload"))


def _prohibited(i: Inputs) -> DataFrame:
    found = contract.prohibited(F.col("value"), F.try_parse_json("value"))
    return sample.nested_arrivals(i.spark, i.sf_dir).select("ordinal", found.alias("prohibited"))


def _two_runs(i: Inputs) -> TableStore:
    """Tables kept by two runs: the events up to a version, then the rest, which reopen some of the payments."""
    events = written(i.events().withColumns({"source_id": F.lit("checkout-01"), "received_at": F.col("event_time"), "customer_token": F.lit(None).cast("string")}), "events")
    late = F.col("transaction_version") > 2
    store = TableStore(i.spark, f"{shared_folder(i.spark)}/incremental-{uuid.uuid4().hex}")
    # The sample has few events a day, so its days are no directories.
    store.bootstrap(workflow.TABLES, bucket_by=workflow.LAYOUT["bucket_by"])
    rules = posting.rules_frame(i.spark)
    for part in (~late, late):
        with store.commit(f"part-{uuid.uuid4().hex}") as change:
            new = events.filter(part).select(*contract.EVENT_COLUMNS, F.to_date("event_time").alias("event_date"))
            change.append("accepted_event", new)
            workflow.project(change, new, rules)
    return store


def _incremental(i: Inputs) -> DataFrame:
    """State of payments and what of their lines counts."""
    store = _two_runs(i)
    ledger = marts.excluding(store.read("ledger_entry"), store.read("business_exception")).groupBy("transaction_id").agg(F.count("*").alias("n_lines"), F.sum(F.abs("signed_minor")).alias("turnover_minor"))
    state = store.read("payment_state").join(ledger, "transaction_id", "left")
    return state.fillna(0, ["n_lines", "turnover_minor"])


def _source_verdicts(i: Inputs) -> DataFrame:
    return marts.source_verdicts(i.checked().filter("reason IS NULL"), control.registry(i.spark), "1998-08-01 00:10:00")


def _freshness(i: Inputs) -> DataFrame:
    return marts.freshness(i.checked().filter("reason IS NULL")).select("source_id", F.col("latest_event").cast("timestamp_ntz").alias("latest_event"), F.col("latest_arrival").cast("timestamp_ntz").alias("latest_arrival"), "longest_lag_seconds")


def _stream(i: Inputs) -> DataFrame:
    from .streaming import gate

    return gate.replay(i.spark, written(sample.raw_arrivals(i.spark, i.sf_dir), "arrivals"), control.registry(i.spark), SAMPLE_KEY)


def _stream_conservation(i: Inputs) -> DataFrame:
    """What the stream counted batch by batch, summed up."""
    from .streaming import gate, metrics

    return metrics.conservation(gate.replayed(i.spark, written(sample.raw_arrivals(i.spark, i.sf_dir), "arrivals"), control.registry(i.spark), SAMPLE_KEY).read("batch_metrics"))


QUERIES: dict[str, Query] = {
    "payment_events_adapter": _over(lambda i: sample.payment_events(i.spark, i.sf_dir).drop("k", "seq", "custkey")),
    "accepted_typed_projection": _over(lambda i: i.checked().filter("reason IS NULL").select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in ("event_time", "received_at") else c for c in contract.EVENT_COLUMNS if c != "customer_token"])),
    "contract_reason_histogram": _over(lambda i: i.checked().groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))),
    "identity_outcomes": _over(lambda i: i.outcomes().select("ordinal", "outcome", "reason")),
    "outcome_histogram": _over(lambda i: identity.histogram(i.outcomes())),
    "raw_conservation": _over(lambda i: identity.conservation(i.outcomes())),
    "customer_token_hmac": _over(lambda i: i.checked().filter("reason IS NULL").select("ordinal", "customer_token")),
    "identity_fingerprint": _over(lambda i: i.checked().filter("reason IS NULL").select("ordinal", "fingerprint")),
    "redacted_payloads": _over(_redactions),
    "prohibited_key_scan": _over(_prohibited),
    "cdc_unwrap": _over(_cdc),
    "source_registry_expand": _over(_registry),
    "posting_rules": _over(_rules),
    "txn_assessment": _over(lambda i: i.assessed().select(*ASSESSED)),
    "txn_assessment_window_form": _over(_window_form),
    "business_exceptions": _over(lambda i: i.exceptions()),
    "payment_state_current": _over(lambda i: i.state()),
    "payment_state_status_counts": _over(lambda i: i.state().groupBy("status").agg(F.count("*").alias("n"))),
    "business_error_counts": _over(lambda i: i.assessed().filter("business_error IS NOT NULL").groupBy("business_error").agg(F.count("*").alias("n"))),
    "touched_history": _over(lambda i: lifecycle.touched_history(i.events(), TOUCHED_DATE)),
    "posted_events": _over(lambda i: i.posted()),
    "ledger_lines": _over(lambda i: i.ledger()),
    "ledger_balance_check": _over(lambda i: posting.unbalanced(i.ledger())),
    "ledger_unbalanced_injected": _over(_injected),
    "account_trial_balance": _over(lambda i: marts.trial_balance(i.ledger())),
    "fct_ledger_daily": _over(lambda i: marts.ledger_daily(i.ledger(), i.exceptions())),
    "dim_payment_current": _over(lambda i: i.current()[0]),
    "fct_settlement_exception": _over(lambda i: marts.settlement_exceptions(i.settlement_exceptions())),
    "expected_settlement": _over(lambda i: i.expected()),
    "settlement_reconciliation": _over(lambda i: i.compared()),
    "settlement_gate_summary": _over(lambda i: settlement.gate(i.settlement_exceptions())),
    "settlement_contract_violations": _over(lambda i: settlement.violations(_broken_evidence(i))),
    "settlement_duplicate_keys": _over(lambda i: settlement.duplicate_keys(_twice(i))),
    "manifest_control_totals": _over(lambda i: settlement.control_totals(i.evidence())),
    "revision_registry_decision": _over(_registry_decisions),
    "merge_insert_only": _over(lambda i: merging.insert_only(*_halves(i), ["transaction_id"])),
    "merge_upsert": _over(lambda i: merging.upsert(*_halves(i), ["transaction_id"])),
    "overwrite_where": _over(_overwritten),
    "audit_settlement_ranked": _over(lambda i: marts.settlement_ranked(i.settlement_exceptions(), "1995-03-05")),
    "audit_payment_trace": _over(lambda i: marts.payment_trace(i.events(), TRACE_ID)),
    "dq_unique": _over(lambda i: marts.repeated(i.ledger(), "entry_id")),
    "dq_not_null": _over(lambda i: marts.null_counts(i.ledger(), "entry_id", "event_id", "transaction_id", "signed_minor")),
    "dq_accepted_values": _over(lambda i: marts.outside_domain(i.state())),
    "dq_relationships": _over(_orphans),
    "dq_no_invalid_current": _over(lambda i: marts.invalid_in_current(*i.current())),
    "dq_no_zero_delta": _over(lambda i: i.settlement_exceptions().filter("delta_minor = 0")),
    "freshness_lag": _over(_freshness),
    "freshness_verdicts": _over(_source_verdicts),
    "incremental_projection": _over(_incremental),
    "incremental_ledger_daily": _over(lambda i: _two_runs(i).read("ledger_daily")),
    "state_hash": _over(lambda i: marts.state_hash(i.state())),
    "stream_identity_gate": _over(_stream),
    "stream_conservation": _over(_stream_conservation),
    "generated_lifecycle": _over(lambda i: generator.lifecycles(i.spark.read.parquet(f"{i.sf_dir}/orders.parquet").select((F.col("o_orderkey") + 1).alias("n")))),
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in oracle.SQL.items() if name in QUERIES}
