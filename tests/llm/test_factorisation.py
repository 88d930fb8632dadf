from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paytrail.llm import fm, quality, toxicity

from paytrail.llm.textkernels import mix, span_hashes

from .texts import DOCS, prose, words

SMALL = fm.Settings(rounds=12, least_documents=5, shards=2, least_chi2=4.0, batch=8)
LABELS = "doc_id long, label int"


def test_pair_term_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = fm.Machine(np.zeros(1, np.int32), 0.3, rng.normal(size=9), rng.normal(size=(9, 4)))
    sets = [[0, 3, 8], [], [5], [1, 2, 4, 6, 7]]
    limits = np.cumsum([0] + [len(s) for s in sets])
    margin, _ = m.margin(np.array(sum(sets, [])), limits)
    for s, got in zip(sets, margin, strict=True):
        want = 0.3 + sum(m.weights[i] for i in s) + sum(m.factors[i] @ m.factors[j] for i in s for j in s if i < j)
        assert got == pytest.approx(want)


def test_gradient_step_lowers_the_loss():
    rng = np.random.default_rng(2)
    sets = [sorted(rng.choice(12, 5, replace=False)) for _ in range(300)]
    label = np.array([float(0 in s and 1 in s) for s in sets])  # a pair decides, no single feature does
    feature, limits = np.concatenate(sets), np.arange(0, 1501, 5)
    m = fm.Machine(np.zeros(1, np.int32), 0.0, np.zeros(12), rng.normal(0, 0.1, (12, 4)))
    loss = lambda: -np.mean(np.log(np.where(label == 1, fm.sigmoid(m.margin(feature, limits)[0]), 1 - fm.sigmoid(m.margin(feature, limits)[0]))))
    before = loss()
    for turn in range(40):
        m.fit(feature, limits, label, fm.Settings(batch=32), turn)
    assert loss() < 0.5 * before
    assert ((fm.sigmoid(m.margin(feature, limits)[0]) > 0.5) == label).mean() > 0.95


def planted(n=400):
    """Texts of which some hold an insult, in several inflections."""
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        text = prose(40 + i % 60, 5_000 + i)
        if bad:
            w = text.split(" ")
            w[random.Random(i).randrange(len(w))] = "Zorgl" + ["", "ing!", "est,", "ov."][i // 25 % 4]
            text = " ".join(w)
        rows.append((i, text))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_texts(spark):
    rows, labels = planted()
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame([x for x in labels if x[0] % 4], LABELS)
    out = {r["doc_id"]: r for r in toxicity.score(docs, known, settings=SMALL).collect()}
    held = [(out[i]["predicted"], label) for i, label in labels if i % 4 == 0]
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out.values())
    assert np.mean([p == y for p, y in held]) > 0.95


def test_quality_on_held_out_texts(spark):
    rows, labels = [], []
    for i in range(300):
        good = i % 3 != 0
        text = prose(60, 9_000 + i)
        rows.append((i, text if good else " ".join(w.upper() + "!!" for w in text.split(" "))))
        labels.append((i, int(good)))
    docs = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", score string")
    machine = quality.fit(docs, spark.createDataFrame([x for x in labels if x[0] % 4], LABELS), SMALL)
    out = quality.score(docs, machine, "_s", "_p")
    assert out.columns == ["doc_id", "text", "score", "_s", "_p"]
    got = {r["doc_id"]: r["_p"] for r in out.collect()}
    assert np.mean([got[i] == y for i, y in labels if i % 4 == 0]) > 0.97


def test_odd_rows_and_odd_labels(spark):
    rows, labels = planted(120)
    odd = [(None, None), (1_000, None), (1_001, ""), (1_002, "x" * 300_000), (1_003, "y " * 60_000), (5, "again")]
    docs = spark.createDataFrame(rows + odd, DOCS)
    known = spark.createDataFrame([*labels, (None, 1), (7, None), (8, 5), (10, 0)], LABELS)
    out = toxicity.score(docs, known, settings=SMALL).collect()
    assert len(out) == len(rows) + len(odd)
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in out)


def one_hash(word: bytes) -> int:
    return int(span_hashes(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0])


def one_score(machine, buckets):
    """The score of a text by the sum over all pairs of its features, one by one."""
    own = sorted({int(machine.slot[b]) for b in buckets if machine.slot[b] >= 0})
    margin = machine.bias + sum(machine.weights[i] for i in own) + sum(machine.factors[i] @ machine.factors[j] for i in own for j in own if i < j)
    return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def toxic_buckets(text):
    out = set()
    for w in words(text):
        raw = w.encode().strip(bytes((*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127))))
        if raw:
            out.add(one_hash(raw) % fm.BUCKETS)
            out |= {int(mix(np.array([one_hash(raw[:n]) + n], np.uint64))[0]) % fm.BUCKETS for n in toxicity.PREFIXES if len(raw) >= n}
    return out


def quality_buckets(text):
    raw, held = (text or "").encode(), [w.encode() for w in (text or "").split()]
    low = [w.encode() for w in words(text)]
    share = lambda n, of: n / max(of, 1)
    letter = lambda c: 97 <= c | 32 <= 122
    symbol = lambda c: not letter(c) and not 48 <= c <= 57 and 32 < c < 127 and c not in (44, 46)
    by_byte = [lambda c: 65 <= c <= 90, lambda c: 48 <= c <= 57, symbol, lambda c: c >= 128, lambda c: c == 10]
    by_word = [lambda w: w[-1:] == b"!", lambda w: len(w) == 1 and not letter(w[0]), lambda w: w[-1:] in [bytes([c]) for c in b"*%&#$@~^=|"], lambda w: 65 <= w[0] <= 90, lambda w: w[-1:] in (b".", b","), lambda w: len(w) >= 14]
    values = [share(sum(map(f, raw)), len(raw)) for f in by_byte]
    values.append(share(sum(a == b for a, b in zip(low, low[1:])), len(low)))
    values += [share(sum(map(f, held)), len(held)) for f in by_word]
    values.append(1 - len(set(low)) / max(len(low), 1))
    bins = [64 * k + int(np.searchsorted(quality.SHARES, v, side="right")) for k, v in enumerate(values)]
    lengths = [len(held), len(raw), len(raw) / max(len(held), 1)]
    bins += [64 * (len(values) + k) + int(np.searchsorted(quality.LENGTHS, v, side="right")) for k, v in enumerate(lengths)]
    return {one_hash(w) % fm.BUCKETS for w in low} | {int(mix(np.array([b + (1 << 40)], np.uint64))[0]) % fm.BUCKETS for b in bins}


ODD = [(900, None), (901, ""), (902, "!!!!!!!!!!!!!!zorgl!!!!!!!!!!!!!! ..."), (903, "Mé MÉ 12,5% a a A\n\nB- x" * 40), (904, "word " * 3_000), (905, "\n")]


def test_whole_scores_equal_brute_force(spark):
    rows, labels = planted(200)
    docs, known = spark.createDataFrame(rows + ODD, DOCS), spark.createDataFrame(labels, LABELS)
    for module, featurise, buckets in ((toxicity, toxicity.terms, toxic_buckets), (quality, quality.features, quality_buckets)):
        machine = fm.fit(docs, known, featurise, SMALL)
        assert len(machine.weights) > 3
        got = {r["doc_id"]: r["score"] for r in fm.apply(docs, machine, featurise).collect()}
        for i, text in rows[:40] + ODD:
            assert got[i] == pytest.approx(one_score(machine, buckets(text)), abs=1e-9), (module.__name__, i)


def test_clashing_columns_are_replaced(spark):
    rows, labels = planted(60)
    docs = spark.createDataFrame([(*r, "own", 7, "x") for r in rows], DOCS + ", score string, predicted int, label string")
    out = toxicity.score(docs, spark.createDataFrame(labels, LABELS), settings=SMALL)
    assert sorted(out.columns) == ["doc_id", "label", "predicted", "score", "text"] and all(0 <= r["score"] <= 1 for r in out.collect())
    machine = quality.fit(docs, spark.createDataFrame(labels, LABELS), SMALL)
    assert set(quality.score(docs, machine).columns) == set(docs.columns)
    odd = docs.selectExpr("*", "'x' AS `back``tick`", "named_struct('a b', 1, 'c', array(1.5)) AS nested")
    scored = quality.score(odd, machine)
    assert set(scored.columns) == set(odd.columns) and scored.filter("`back``tick` = 'x' AND nested.`a b` = 1").count() == odd.count()


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a")], DOCS)
    none = spark.createDataFrame([], LABELS)
    assert toxicity.score(docs, none).first()["score"] == pytest.approx(0.5)
    assert toxicity.score(docs.limit(0), none).count() == 0
    one = spark.createDataFrame([(1, 1)], LABELS)
    assert quality.score(docs, quality.fit(docs, one)).first()["predicted"] == 1


def test_terms_know_inflections():
    text, bucket = toxicity.terms(pa.chunked_array([["Zorgling zorgles", "zorgl"]]))
    first = set(bucket[text == 0])
    assert set(bucket[text == 1]) - first and len(first & set(bucket[text == 1])) >= 1


def test_held_out_rule(spark):
    from zlib import crc32

    rows, labels = planted(80)
    docs = spark.createDataFrame(rows, DOCS)
    own = spark.createDataFrame(labels, LABELS).select("doc_id", F.col("label").alias("toxic"), F.col("label").alias("quality"))
    for f, modulus, left in ((toxicity.held_out_scores, 4, 2), (quality.held_out_scores, 5, 0)):
        assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % modulus == left) for r in f(docs, own).collect())
