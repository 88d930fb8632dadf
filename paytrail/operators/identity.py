"""Identity of events: the first arrival of an identifier is accepted, equal ones are duplicates, others conflict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCEPTED, DUPLICATE, CONFLICT = ("ACCEPTED", "contract_and_identity_passed"), ("DUPLICATE", "exact_event_replay"), ("QUARANTINED", "identity_payload_conflict")


def classify(valid: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """valid (event_id, fingerprint, ordinal, ...) with outcome and reason.

    The arrival with the least ordinal decides an identifier's fingerprint, unless
    seen (event_id, fingerprint) has it from earlier runs.  The winners are found by
    aggregation and joined back, so an identifier that arrives very often is split
    by the join rather than gathered.
    """
    winners = valid.groupBy("event_id").agg(F.min(F.struct("ordinal", "fingerprint")).alias("_first"))
    winners = winners.select("event_id", F.col("_first.ordinal").alias("_ordinal"), F.col("_first.fingerprint").alias("_own"))
    if seen is None:
        winners = winners.withColumn("_known", F.lit(None).cast("string"))
    else:
        winners = winners.join(seen.select("event_id", F.col("fingerprint").alias("_known")), "event_id", "left")
    joined = valid.join(winners, "event_id")
    accepted = F.col("_known").isNull() & (F.col("ordinal") == F.col("_ordinal"))
    same = F.col("fingerprint") == F.coalesce("_known", "_own")
    pick = lambda i: F.when(accepted, ACCEPTED[i]).when(same, DUPLICATE[i]).otherwise(CONFLICT[i])
    return joined.withColumns({"outcome": pick(0), "reason": pick(1)}).drop("_ordinal", "_own", "_known")


def newly_seen(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("outcome") == ACCEPTED[0]).select("event_id", "fingerprint")


def histogram(outcomes: DataFrame) -> DataFrame:
    """(outcome, reason, n), with one line for all arrivals."""
    own = outcomes.groupBy("outcome", "reason").agg(F.count("*").alias("n"))
    every = outcomes.agg(F.count("*").alias("n")).select(F.lit("ARRIVAL").alias("outcome"), F.lit("raw_record_read").alias("reason"), "n")
    return own.unionByName(every)


def conservation(outcomes: DataFrame) -> DataFrame:
    """One row: arrivals, what became of them, and whether all are accounted for."""
    of = lambda name: F.count(F.when(F.col("outcome") == name, 1))
    counted = outcomes.agg(F.count("*").alias("arrivals"), of("ACCEPTED").alias("accepted"), of("DUPLICATE").alias("duplicates"), of("QUARANTINED").alias("quarantined"))
    return counted.withColumn("conserved", F.col("arrivals") == F.col("accepted") + F.col("duplicates") + F.col("quarantined"))
