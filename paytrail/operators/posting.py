"""Double-entry posting of monetary events by versioned rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..vocabulary import EVENT_TYPES, POSTING_RULES

MONETARY = ("capture", "refund", "chargeback")


def rules_frame(spark: SparkSession, rules=POSTING_RULES, version: int = 1) -> DataFrame:
    """(event_type, position, account, multiplier, version), a row for each line that an event type posts."""
    rows = [(kind, i, account, int(times), version) for kind, lines in rules.items() for i, (account, times) in enumerate(lines, 1)]
    return spark.createDataFrame(rows, "event_type string, position int, account string, multiplier int, version int")


def check_rules(rules: dict, version: object, unit: object) -> None:
    """Refuses rules that can't be posted from: wrong unit, version or event types, or lines that don't balance."""
    if unit != "minor":
        raise ValueError("unsupported_currency_unit")
    if isinstance(version, bool) or not isinstance(version, int) or version < 1:
        raise ValueError("invalid_posting_rule_version")
    if set(rules) != set(EVENT_TYPES):
        raise ValueError("posting_rule_event_types")
    for kind, lines in rules.items():
        for account, times in lines:
            if not isinstance(account, str) or not account.strip():
                raise ValueError(f"invalid_posting_account:{kind}")
            if isinstance(times, bool) or not isinstance(times, int):
                raise ValueError(f"invalid_posting_multiplier:{kind}")
        if sum(times for _, times in lines):
            raise ValueError(f"unbalanced_posting_rule:{kind}")


def due(event_type: Column, business_error: Column) -> Column:
    """Whether an event is to be posted, if its payment's figures are beside it."""
    return event_type.isin(*MONETARY) & business_error.isNull()


def postable(events: DataFrame, assessed: DataFrame) -> DataFrame:
    """Monetary events of the transactions that no rule excludes."""
    bad = assessed.filter("business_error IS NOT NULL").select("transaction_id")
    return events.filter(F.col("event_type").isin(*MONETARY)).join(bad, "transaction_id", "left_anti")


def post(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Ledger lines; the rules are a handful of rows, one set for each version, and go to every task."""
    lines = events.join(F.broadcast(rules), "event_type")
    return lines.select(
        F.concat_ws(":", "event_id", F.col("position").cast("string")).alias("entry_id"),
        "event_id",
        "transaction_id",
        "processor_id",
        "merchant_id",
        "currency",
        "event_time",
        "account",
        (F.col("amount_minor") * F.col("multiplier")).alias("signed_minor"),
        F.col("version").alias("posting_rule_version"),
    )


def unbalanced(lines: DataFrame) -> DataFrame:
    """Events and currencies whose lines don't sum to zero."""
    return lines.groupBy("event_id", "currency").agg(F.sum("signed_minor").alias("balance_minor")).filter("balance_minor <> 0")


def require_balanced(lines: DataFrame) -> None:
    if not unbalanced(lines).isEmpty():
        raise RuntimeError("double-entry gate failed")
