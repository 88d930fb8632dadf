"""Spark sessions set up for money: UTC, ANSI arithmetic, adaptive plans."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that results depend on.
REQUIRED = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}
#: Settings that only plans depend on; a cluster may set others.
PREFERRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build(master: str | None = None, name: str = "paytrail", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config(map=PREFERRED | REQUIRED | more)
    return (builder.master(master) if master else builder).getOrCreate()


def require(spark: SparkSession) -> None:
    """Stops if a setting would change results."""
    for key, value in REQUIRED.items():
        if (spark.conf.get(key) or "").lower() != value.lower():
            raise ValueError(f"{key} must be {value}")
