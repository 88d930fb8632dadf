"""Finance marts, audits and data tests over the payment tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from ..vocabulary import STATUSES


def excluding(rows: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Rows of transactions that no exception, however late, has invalidated."""
    return rows.join(exceptions.select("transaction_id"), "transaction_id", "left_anti")


def payment_current(state: DataFrame, exceptions: DataFrame) -> DataFrame:
    net = F.col("captured_minor") - F.col("refunded_minor") - F.col("chargeback_minor")
    return excluding(state, exceptions).withColumn("net_processor_receivable_minor", net)


DAILY_KEYS = ("business_date", "processor_id", "merchant_id", "currency", "account")


def ledger_daily(ledger: DataFrame, exceptions: DataFrame) -> DataFrame:
    lines = excluding(ledger, exceptions).withColumn("business_date", F.to_date("event_time"))
    return lines.groupBy(*DAILY_KEYS).agg(F.count("*").alias("entry_count"), F.sum("signed_minor").alias("signed_minor"))


def daily_parts(lines: DataFrame, times: Column | None = None) -> DataFrame:
    """What each line adds to ledger_daily, so many times (below nothing: takes away)."""
    times = F.lit(1).cast("long") if times is None else times
    return lines.select(F.to_date("event_time").alias("business_date"), *DAILY_KEYS[1:], times.alias("entry_count"), (times * F.col("signed_minor")).alias("signed_minor"))


def summed_daily(rows: DataFrame) -> DataFrame:
    """Daily sums of which nothing is left are gone."""
    summed = rows.groupBy(*DAILY_KEYS).agg(F.sum("entry_count").alias("entry_count"), F.sum("signed_minor").alias("signed_minor"))
    return summed.filter("entry_count <> 0 OR signed_minor <> 0")


def settlement_exceptions(found: DataFrame) -> DataFrame:
    return found.withColumn("exception_reason", F.lit("settlement_delta"))


def trial_balance(ledger: DataFrame) -> DataFrame:
    """Net amount by account and currency; each currency sums to zero."""
    return ledger.groupBy("account", "currency").agg(F.sum("signed_minor").alias("balance_minor"), F.count("*").alias("entry_count"))


def settlement_ranked(found: DataFrame, business_date: str) -> DataFrame:
    """The day's differences, largest first."""
    return found.filter(F.col("business_date") == F.to_date(F.lit(business_date))).orderBy(F.abs("delta_minor").desc(), "processor_id", "currency")


def payment_trace(events: DataFrame, transaction_id: str) -> DataFrame:
    """A payment's events in order, without customer data."""
    columns = ("transaction_id", "transaction_version", "event_type", "amount_minor", "currency", "event_time", "processor_id")
    return events.filter(F.col("transaction_id") == transaction_id).select(*columns).orderBy("transaction_version", "event_time")


# -- data tests: rows are failures ------------------------------------------------------------------


def repeated(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def null_counts(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.agg(*(F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_nulls") for c in columns))


def outside_domain(state: DataFrame) -> DataFrame:
    return state.filter(~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)))


def orphans(ledger: DataFrame, accepted: DataFrame) -> DataFrame:
    """Ledger lines without an accepted event.

    Identifiers alone are exchanged; those of no event are written, so that lines needn't be exchanged for the few there are.
    A line without an identifier has no event either.
    """
    missing = written(ledger.select("event_id").distinct().join(accepted.select("event_id"), "event_id", "left_anti"), "missing")
    return ledger.join(missing, ledger["event_id"].eqNullSafe(missing["event_id"]), "left_semi")


def invalid_in_current(current: DataFrame, exceptions: DataFrame) -> DataFrame:
    return current.join(exceptions.select("transaction_id"), "transaction_id", "left_semi")


def freshness(events: DataFrame, received: str = "received_at") -> DataFrame:
    """Lag of the latest event behind the latest arrival, for each source."""
    return events.groupBy("source_id").agg(F.max("event_time").alias("latest_event"), F.max(received).alias("latest_arrival"), F.max(F.unix_timestamp(received) - F.unix_timestamp("event_time")).alias("longest_lag_seconds"))


#: Minutes after which a source table is late, and stale.  Fixed values.
WARN_MINUTES, ERROR_MINUTES = 15, 60


def verdict_on(lag_minutes: Column, warn: Column | int = WARN_MINUTES, error: Column | int = ERROR_MINUTES) -> Column:
    return F.when(F.coalesce(lag_minutes > error, F.lit(True)), "error").when(lag_minutes > warn, "warn").otherwise("pass")


def source_verdicts(events: DataFrame, registry: DataFrame, now: str | None = None, received: str = "received_at") -> DataFrame:
    """(source_id, minutes, freshness_minutes, verdict) of every registered payment source: late beyond its own limit, stale beyond four times that."""
    at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    latest = events.groupBy("source_id").agg(F.max(received).alias("latest"))
    sources = registry.filter("contract = 'payment_event'").select("source_id", "freshness_minutes")
    minutes = (F.unix_timestamp(at) - F.unix_timestamp("latest")) / 60
    judged = sources.join(latest, "source_id", "left").withColumn("minutes", F.floor(minutes))
    return judged.withColumn("verdict", verdict_on(minutes, F.col("freshness_minutes"), 4 * F.col("freshness_minutes"))).select("source_id", "minutes", "freshness_minutes", "verdict")


def staging(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The views that marts and tests read, each with the time (processed_at) by which its freshness is judged."""
    accepted, state, ledger, bad, settled = (tables[t] for t in ("accepted_event", "payment_state", "ledger_entry", "business_exception", "settlement_exception"))
    times = accepted.groupBy("transaction_id").agg(F.max("received_at").alias("processed_at"))
    return {
        "stg_accepted_event": accepted.selectExpr("event_id", "transaction_id", "transaction_version", "processor_id", "merchant_id", "event_type", "amount_minor", "currency", "event_time", "received_at AS processed_at"),
        "stg_payment_state": state.join(times, "transaction_id", "left"),
        "stg_ledger_entry": ledger.withColumn("processed_at", F.col("event_time")),
        "stg_business_exception": bad.groupBy("transaction_id", "business_error").agg(F.max("received_at").alias("processed_at")),
        "stg_settlement_exception": settlement_exceptions(settled).withColumn("processed_at", F.col("business_date").cast("timestamp")),
    }


def source_freshness(views: dict[str, DataFrame], now: str | None = None) -> DataFrame:
    """(source_table, minutes, verdict) of the two source tables that have limits."""
    at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    lag = lambda name: views[f"stg_{name}"].agg(((F.unix_timestamp(at) - F.unix_timestamp(F.max("processed_at"))) / 60).alias("m")).select(F.lit(name).alias("source_table"), F.floor("m").alias("minutes"), verdict_on(F.col("m")).alias("verdict"))
    return lag("accepted_event").unionByName(lag("payment_state"))


def state_hash(state: DataFrame) -> DataFrame:
    """One row that is the same for the same rows in any order: their number, and a digest of it and two sums of row digests."""
    own = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in sorted(state.columns)]
    digest = F.md5(F.concat(*own).cast("binary"))
    part = lambda at: F.coalesce(F.sum(F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("string")
    return state.agg(F.count("*").alias("n_rows"), F.sha2(F.concat_ws("|", F.count("*").cast("string"), part(1), part(16)), 256).alias("state_sha256"))
