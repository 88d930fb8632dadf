"""The folder that driver and executors share, and tables written there once to be read several times."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The second version writes identifiers by what they differ in from those before.
WRITING = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}
_own: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder if the session is local, else an error."""
    conf = spark.sparkContext.getConf()
    if folder := conf.get("spark.checkpoint.dir"):
        return folder.rstrip("/")
    master = conf.get("spark.master") or ""
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _own
    _own = _own or "file://" + tempfile.mkdtemp(prefix="paytrail-")
    return _own


def written(rows: DataFrame, name: str) -> DataFrame:
    """rows as a table in the shared folder; cuts the lineage, so that readers don't compute it again."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    rows.write.options(**WRITING).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
