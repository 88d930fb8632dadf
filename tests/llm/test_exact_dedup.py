from __future__ import annotations

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from paytrail.llm import exact_dedup

from .texts import DOCS, corpus, lower


def expected(rows, pick):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[lower(t)] if x is not None]
        keep = pick(ids) if ids else None
        out.append((i, keep, len(groups[lower(t)]), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_equals_brute_force(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    assert got(exact_dedup.deduplicate(docs, "largest")) == expected(corpus(), max)
    assert got(exact_dedup.deduplicate(docs, "smallest")) == expected(corpus(), min)


def test_colliding_digests_are_told_apart_by_bytes(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 1).cast("binary")
    assert got(exact_dedup.deduplicate(docs, "largest", digest=weak)) == expected(corpus(), max)


def test_batches_give_the_same_as_one_flush(spark):
    rows = corpus()
    parts = [spark.createDataFrame(rows[a::3], DOCS) for a in range(3)]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert got(exact_dedup.deduplicate(whole, "largest", batches=parts)) == expected(rows, max)


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert got(exact_dedup.deduplicate(docs)) == []
    assert exact_dedup.drop_copies(docs).count() == 0


def test_drop_copies_keeps_columns_and_one_of_repeated_rows(spark):
    rows = [(1, "a", "kept", True), (2, "A", "kept", False), (2, "A", "kept", False), (3, None, None, None), (4, "", "digest", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_id string, kept boolean")
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(2, "A", "kept", False), (4, "", "digest", True)]


def test_runs_on_built_in_functions_only(spark):
    plan = exact_dedup.deduplicate(spark.createDataFrame(corpus(), DOCS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
