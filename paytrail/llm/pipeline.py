"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs.  All but the last return the
columns of documents, extra ones included, whatever their names.

Defined results: a null text counts as empty; an empty table stays empty; rows that
repeat identifier and text go together, but for exact dedup, which keeps one of them.  Ties are
settled by identifier: exact dedup keeps the largest, near dedup the smallest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, exact_dedup, packing, quality, simhash
from .common import Scratch, fresh, quoted, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    machine = quality.fit(docs, quality.learnable(table(spark, sf_dir, "labels")))
    score, good = fresh("quality_score", docs.columns), fresh("quality_good", docs.columns)
    scored = quality.score(docs, machine, score, good)
    return scored.filter(F.col(good) == 1).select(*map(quoted, docs.columns))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest identifier."""
    return exact_dedup.drop_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest identifier."""
    return simhash.drop_near_copies(docs, words=5, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document and its place in a packed sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: The learned and hashed stages can't be said in SQL; tests hold each stage's decisions against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is a written table."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    previous = None
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if previous:
            scratch.drop(previous)
        previous = name
    return docs
