from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
from paytrail.llm import backoff_lm, decontamination, packing, registry, simhash, suffix_dedup

from .test_simhash import kept_by_brute_force
from .texts import lower, prose, words

SAMPLE = "/root/testdata/sf0.001"


def test_stages_over_the_smallest_sample(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SAMPLE)
        if name != "best_fit_packing":
            assert docs.columns == columns
            assert 0 < docs.count() <= n
            n = docs.count()
            docs = docs.checkpoint()
    assert docs.select("doc_id").distinct().count() == n


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SAMPLE).checkpoint()
        assert docs.count() == 0


def test_decisions_equal_brute_force(spark, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows and clashing columns, stage by stage."""
    base = [prose(150, 40 + i, 3_000) for i in range(12)]
    leak = prose(40, 99, 3_000)
    rows = [(i, t, "a") for i, t in enumerate(base)] + [(100 + i, base[i].upper() if i % 2 else base[i], "a") for i in range(4)]
    rows += [(200 + i, " ".join(base[i].split()[:-3] + ["z"]), "b") for i in range(4)] + [(300, base[0] + " " + leak + " " + base[1], "c"), (301, prose(6_000, 7, 3_000), "c")]
    rows += [(400, None, None), (401, "", "d"), (402, "", "d"), (None, base[5], "e"), (7, base[7], "a"), (500, "one two", None)]
    schema = "doc_id long, text string, source string"
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "'en' AS lang", "1 AS n_chars", "'own' AS _quality", "'own' AS gone_id", "1.5 AS node", "'own' AS own_sha", "'own' AS row")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(12)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    table = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)

    good = stages["quality_classifier"](spark, docs, str(tmp_path)).checkpoint()
    assert good.columns == docs.columns and table(good) == table(docs)  # one class of labels: the same score for all, above the threshold
    single = stages["exact_dedup"](spark, good, str(tmp_path)).checkpoint()
    held = defaultdict(list)
    for i, t, _ in rows:
        held[lower(t)].append((i, t))
    want = []
    for own in held.values():
        most = max((i for i, _ in own if i is not None), default=None)
        want.append(next(x for x in own if x[0] == most))
    assert single.columns == docs.columns and table(single) == sorted(want, key=str)
    near = stages["simhash_near_dedup"](spark, single, str(tmp_path)).checkpoint()
    kept = kept_by_brute_force(sorted(want, key=lambda x: x[0]))
    assert near.columns == docs.columns and sorted(r["doc_id"] for r in near.collect()) == kept
    clean = stages["benchmark_decontamination"](spark, near, str(tmp_path)).checkpoint()
    assert clean.columns == docs.columns and sorted(r["doc_id"] for r in clean.collect()) == [i for i in kept if i != 300]
    packed = stages["best_fit_packing"](spark, clean, str(tmp_path))
    assert packed.groupBy().sum("n_tokens").first()[0] == sum(len(words(t)) + 1 for i, t in want if i in kept and i != 300)


def test_one_query_for_each_operator():
    names = list(registry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names and set(registry.oracle_sql()) <= set(names)


def test_columns_that_operators_use_themselves_may_be_there(spark):
    rows = [(i, prose(80, i % 3), "own", 1.5) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, key double").selectExpr("*", "'x' AS hash", "'x' AS fp", "'x' AS prints", "'x' AS n_tokens", "'x' AS bin_id", "'x' AS score", "'x' AS component_id", "true AS held")
    item = spark.createDataFrame([(1, rows[0][1], "x")], "item_id long, text string, hash string")
    spans = suffix_dedup.repeated_passages(docs)
    assert {r["doc_id"] for r in spans.collect()} == set(range(6)) and "key" not in spans.columns
    assert {r["component_id"] for r in simhash.near_duplicates(docs).collect()} == {0, 1, 2}
    assert packing.pack(docs).groupBy().sum("n_tokens").first()[0] == 6 * 81
    assert {r["doc_id"] for r in decontamination.contaminated(docs, item).collect()} == {0, 3}
    assert backoff_lm.score_documents(docs).filter("held_out").count() == 6
