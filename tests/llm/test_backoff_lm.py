from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paytrail.llm import backoff_lm
from paytrail.llm.common import remainder

from .texts import DOCS, corpus, words


class Model:
    """The same model as dictionaries, with its recursion written out."""

    def __init__(self, texts, order, least):
        self.c = Counter(tuple(w[i : i + k]) for w in texts for k in range(1, order + 1) for i in range(len(w) - k + 1))
        self.n = sum(len(w) for w in texts)
        self.v = sum(len(g) == 1 for g in self.c)
        self.arcs = {g for g in self.c if len(g) == 1}
        for k in range(2, order + 1):
            self.arcs |= {g for g, c in self.c.items() if len(g) == k and c >= least}
        self.mass = Counter()
        for g in self.arcs:
            if len(g) > 1:
                self.mass[g[:-1]] += self.c[g] - backoff_lm.DISCOUNT

    def p(self, history, word):
        if not history:
            return (self.c[(word,)] + 1) / (self.n + self.v + 1)
        lower = self.p(history[1:], word)
        if not self.mass[history]:
            return lower
        own = (self.c[history + (word,)] - backoff_lm.DISCOUNT) / self.c[history] if history + (word,) in self.arcs else 0
        return own + (1 - self.mass[history] / self.c[history]) * lower


def tokens(text):
    return [*words(text), "\0end"]


@pytest.mark.parametrize(("order", "least"), [(1, 2), (2, 3), (3, 2), (3, 1), (4, 2)])
def test_equals_the_recursion(spark, order, least, monkeypatch):
    monkeypatch.setattr(backoff_lm, "SEGMENT", 64)
    monkeypatch.setattr(backoff_lm, "PART_KEYS", 200)
    rows = [(i, t) for i, t in corpus() if i is not None]
    docs = spark.createDataFrame(rows, DOCS).withColumn("held", remainder(F.col("doc_id"), 7) == 2)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    model = Model([tokens(t) for i, t in rows if not held[i]], order, least)
    got = sorted((r.asDict() for r in backoff_lm.score_documents(docs, order=order, min_count=least).collect()), key=lambda r: (r["doc_id"], r["n_tokens"]))
    assert order == 1 or len(model.mass) > 5
    for r, (i, t) in zip(got, sorted(rows, key=lambda x: (x[0], len(tokens(x[1])))), strict=True):
        w = tokens(t)
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["train_tokens"]) == (i, held[i], len(w), model.n)
        assert r["n_known"] == sum(model.c[(x,)] > 0 for x in w)
        assert r["base_score"] == pytest.approx(sum(math.log10(model.p((), x)) for x in w), abs=1e-6)
        assert r["score"] == pytest.approx(sum(math.log10(model.p(tuple(w[max(0, j - order + 1) : j]), x)) for j, x in enumerate(w)), abs=1e-6)


def test_each_state_sums_to_one():
    model = Model([tokens(t) for _, t in corpus() if t], 3, 2)
    vocabulary = [g[0] for g in model.c if len(g) == 1]
    for history in [*list(model.mass)[:5], ("nowhere",)]:
        unknown = model.p(history, "\0unknown")
        assert sum(model.p(history, w) for w in vocabulary) + unknown == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(None, None), (2, "a b")], DOCS).withColumn("held", F.lit(True))
    out = backoff_lm.score_documents(docs).collect()
    assert sorted(r["n_tokens"] for r in out) == [1, 3]
    assert {r["score"] for r in out} == {0.0} and {r["train_tokens"] for r in out} == {0}
    empty = spark.createDataFrame([], DOCS).withColumn("held", F.lit(False))
    assert backoff_lm.score_documents(empty).count() == 0


def test_rare_words_are_in_pairs_at_any_size(spark):
    rows = [(i, "common " * 100_000) for i in range(3)] + [(10 + i, "seldom found") for i in range(4)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("held", F.lit(False))
    out = {r["doc_id"]: r for r in backoff_lm.score_documents(docs).collect()}
    model = Model([tokens(t) for _, t in rows], 3, 2)
    w = tokens("seldom found")
    assert out[10]["score"] == pytest.approx(sum(math.log10(model.p(tuple(w[max(0, j - 2) : j]), x)) for j, x in enumerate(w)), abs=1e-6)
    assert out[10]["score"] > out[10]["base_score"] + 5


def test_sorted_keys_are_dealt_as_they_lie():
    """Parts are ranges of keys, and sketches within a part are in the order of its keys, so that nothing is sorted again."""
    keys = np.unique(np.random.default_rng(3).integers(0, 2**64, 5000, dtype=np.uint64))
    for parts in (1, 7, 2000):
        dealt = backoff_lm.deal(keys, parts)
        assert [p for p, _ in dealt] == sorted({p for p, _ in dealt}) and max(p for p, _ in dealt) < parts
        assert (np.concatenate([at for _, at in dealt]) == np.arange(len(keys))).all()
        assert all((np.diff(backoff_lm.short(keys[at], parts).astype(np.int64)) >= 0).all() for _, at in dealt)
        asked = [int(p) for k in keys for p in [int(k) * parts >> 64]]
        assert [p for p, at in dealt for _ in at] == asked
        shuffled = np.random.default_rng(4).permutation(keys)
        assert [(p, list(shuffled[at])) for p, at in backoff_lm.deal(shuffled, parts)] == [(p, list(keys[at])) for p, at in dealt]
        told = [{"part": p, "parts": parts, "value": backoff_lm.packed((keys[at] % 5).astype(float))} for p, at in dealt]
        assert (backoff_lm.in_order(told, shuffled) == (shuffled % 5)).all()
        marks = [{"part": p, "parts": parts, "value": backoff_lm.packed(np.packbits(keys[at] % 3 == 0))} for p, at in dealt]
        assert (backoff_lm.bits_in_order(marks, keys) == (keys % 3 == 0)).all()
