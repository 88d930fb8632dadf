"""From accepted events to each payment's state, or the reason why it has none.

A payment is judged as a whole: one failed rule excludes all of its events.  The
default form is one aggregation by transaction, with partial aggregation before
its only exchange; the window form keeps every event beside its payment's figures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rules in the order in which the first that holds is the reason; written over FIGURES.
RULES = (
    ("transaction_version_conflict", "n_versions < n_events"),
    ("transaction_version_gap", "min_version <> 1 OR max_version <> n_events"),
    ("currency_mutation", "min_currency <> max_currency"),
    ("processor_mutation", "min_processor <> max_processor"),
    ("merchant_mutation", "min_merchant <> max_merchant"),
    ("duplicate_authorization", "n_authorizations > 1"),
    ("capture_without_authorization", "n_authorizations = 0 AND captured_minor > 0"),
    ("missing_authorization", "n_authorizations = 0"),
    ("capture_before_authorization", "first_capture <= first_authorization"),
    ("reversal_without_capture", "captured_minor = 0 AND refunded_minor + chargeback_minor > 0"),
    ("reversal_before_capture", "first_reversal <= first_capture"),
    ("capture_exceeds_authorization", "captured_minor > authorized_minor"),
    ("refund_or_chargeback_exceeds_capture", "refunded_minor + chargeback_minor > captured_minor"),
)

#: Statuses in the order in which the first that holds applies.
STATUS_RULES = (
    ("CHARGEDBACK", "captured_minor > 0 AND chargeback_minor > 0 AND refunded_minor + chargeback_minor = captured_minor"),
    ("PARTIALLY_CHARGEDBACK", "chargeback_minor > 0"),
    ("REFUNDED", "captured_minor > 0 AND refunded_minor = captured_minor"),
    ("PARTIALLY_REFUNDED", "refunded_minor > 0"),
    ("CAPTURED", "captured_minor = authorized_minor"),
    ("PARTIALLY_CAPTURED", "captured_minor > 0"),
    ("AUTHORIZED", "true"),
)

AMOUNTS = ("authorized_minor", "captured_minor", "refunded_minor", "chargeback_minor")


def first_that_holds(rules: tuple[tuple[str, str], ...]) -> Column:
    """The name of the first rule that is true; null rules count as false."""
    return F.coalesce(*(F.when(F.expr(rule), F.lit(name)) for name, rule in rules))


def figures() -> dict[str, Column]:
    """Aggregates of one payment's events that the rules speak of."""
    kind, version, amount = F.col("event_type"), F.col("transaction_version"), F.col("amount_minor")
    of = lambda *kinds: kind.isin(*kinds)
    total = lambda k: F.sum(F.when(of(k), amount).otherwise(0))
    return {
        "n_events": F.count(F.lit(1)),
        # Counted in two stages, first by transaction and version, so that no task gathers a much repeated transaction.
        "n_versions": F.count_distinct(version),
        "min_version": F.min(version),
        "max_version": F.max(version),
        "min_currency": F.min("currency"),
        "max_currency": F.max("currency"),
        "min_processor": F.min("processor_id"),
        "max_processor": F.max("processor_id"),
        "min_merchant": F.min("merchant_id"),
        "max_merchant": F.max("merchant_id"),
        "n_authorizations": F.sum(F.when(of("authorization"), 1).otherwise(0)),
        "authorized_minor": F.max(F.when(of("authorization"), amount)),
        "captured_minor": total("capture"),
        "refunded_minor": total("refund"),
        "chargeback_minor": total("chargeback"),
        "first_authorization": F.min(F.when(of("authorization"), version)),
        "first_capture": F.min(F.when(of("capture"), version)),
        "first_reversal": F.min(F.when(of("refund", "chargeback"), version)),
    }


def assess(events: DataFrame) -> DataFrame:
    """One row for each transaction: its figures, its latest event and business_error or null."""
    own = figures()
    latest = F.max_by(F.struct("event_id", "currency", "processor_id", "merchant_id"), F.struct("transaction_version", "event_id")).alias("latest")
    grouped = events.groupBy("transaction_id").agg(*(c.alias(n) for n, c in own.items()), latest)
    return grouped.withColumn("business_error", first_that_holds(RULES))


def assess_by_window(events: DataFrame) -> DataFrame:
    """Every event with its transaction's figures, business_error and, in state_rank, its place from the latest."""
    whole = Window.partitionBy("transaction_id")
    newest_first = whole.orderBy(F.desc("transaction_version"), F.desc("event_id"))
    own = figures()
    # Versions in order are counted where they change; a set over a window would be held for each row.
    version, after = F.col("transaction_version"), F.lag("transaction_version").over(newest_first)
    own["n_versions"] = F.sum(F.when(F.col("_changes"), 1).otherwise(0))
    ranked = events.withColumns({"state_rank": F.row_number().over(newest_first), "_changes": version.isNotNull() & ~version.eqNullSafe(after)})
    with_figures = ranked.withColumns({name: figure.over(whole) for name, figure in own.items()})
    return with_figures.drop("_changes").withColumn("business_error", first_that_holds(RULES))


def current_state(assessed: DataFrame) -> DataFrame:
    """The state of each transaction that no rule excludes."""
    valid = assessed.filter("business_error IS NULL")
    return valid.select(
        "transaction_id",
        F.col("max_version").alias("current_version"),
        F.col("latest.event_id").alias("current_event_id"),
        first_that_holds(STATUS_RULES).alias("status"),
        *AMOUNTS,
        F.col("latest.currency").alias("currency"),
        F.col("latest.processor_id").alias("processor_id"),
        F.col("latest.merchant_id").alias("merchant_id"),
    )


def business_exceptions(events: DataFrame, assessed: DataFrame) -> DataFrame:
    """Every event of an excluded transaction, with the transaction's amounts and the reason."""
    bad = assessed.filter("business_error IS NOT NULL").select("transaction_id", *AMOUNTS, "business_error")
    return events.join(bad, "transaction_id").select(*events.columns, *AMOUNTS, "business_error")


def touched_history(events: DataFrame, business_date: str) -> DataFrame:
    """All events of the transactions that have an event on the (UTC) date; late events reopen whole payments."""
    touched = events.filter(F.to_date("event_time") == F.to_date(F.lit(business_date))).select("transaction_id")
    return events.join(touched, "transaction_id", "left_semi")
