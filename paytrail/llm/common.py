"""Working tables in the cluster's shared folder, and column helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Where it is unset, a single-machine session gets a temporary folder; on a
    cluster that is an error, since executors would not see it.
    """
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    master = conf.get("spark.master") or ""
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _own
    _own = _own or "file://" + tempfile.mkdtemp(prefix="paytrail-")
    return _own


_own: str | None = None
#: Spark's setting to delete the shuffle files of a query once it is done.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Parquet tables of one run, in a folder of its own under the shared one.

    A table written here cuts the lineage: a lost executor costs only the tasks
    of the step that is under way.  What a returned DataFrame still reads stays.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def keep(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Writes df and returns the written table; the shuffle files of the write go with its end."""
        before = self.spark.conf.get(FREE_SHUFFLES, "false")
        self.spark.conf.set(FREE_SHUFFLES, "true")
        try:
            df.write.mode("overwrite").options(**{"compression": "zstd", **options}).parquet(self.at(name))
        finally:
            self.spark.conf.set(FREE_SHUFFLES, before)
        return self.spark.read.schema(df.schema).parquet(self.at(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.at(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; null is empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the identifier as text, modulo modulus; a null identifier gives that of the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def fresh(name: str, taken: list[str]) -> str:
    """name, or with underscores before it, so that it is none of those taken (by whatever case)."""
    held = {c.lower() for c in taken}
    while name.lower() in held:
        name = "_" + name
    return name


def quoted(name: str) -> Column:
    """The column of that very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of (doc_id, key) that may be broadcast, about 40 bytes each.
BROADCAST_GONE = 500_000


def without(docs: DataFrame, gone: DataFrame, key: Column, scratch: Scratch) -> DataFrame:
    """docs without the rows whose identifier and key are in gone (doc_id, key); all columns stay."""
    own_id, own_key = (fresh(c, docs.columns) for c in ("gone_id", "gone_key"))
    listed = scratch.keep(gone.select(F.col("doc_id").alias(own_id), F.col("key").alias(own_key)).distinct(), "gone")
    few = F.broadcast(listed) if listed.count() <= BROADCAST_GONE else listed
    return docs.join(few, docs["doc_id"].eqNullSafe(F.col(own_id)) & (key == F.col(own_key)), "left_anti")
