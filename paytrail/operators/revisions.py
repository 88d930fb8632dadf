"""Which settlement revision counts: decisions over the stored and the incoming revision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decision(stored_revision: Column, stored_sha: Column, revision: Column, sha: Column) -> Column:
    """ACTIVE for a first or higher revision, DUPLICATE for the same one, STALE for a lower, CONFLICT for other content."""
    return (
        F.when(stored_revision.isNull() | (stored_revision < revision), "ACTIVE")
        .when((stored_revision == revision) & (stored_sha == sha), "DUPLICATE")
        .when(stored_revision > revision, "STALE")
        .otherwise("CONFLICT")
    )


def decide(registry: DataFrame, incoming: DataFrame) -> DataFrame:
    """incoming (business_date, revision, sha256) with decision, against registry of the same columns."""
    stored = registry.select("business_date", F.col("revision").alias("_revision"), F.col("sha256").alias("_sha"))
    joined = incoming.join(stored, "business_date", "left")
    return joined.withColumn("decision", decision(F.col("_revision"), F.col("_sha"), F.col("revision"), F.col("sha256"))).drop("_revision", "_sha")
