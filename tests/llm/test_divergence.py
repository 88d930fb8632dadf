from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paytrail.llm import divergence

from .texts import lower, prose

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "lang string, source string, text string"


def brute_force(rows, least, ranks):
    """{(lang, source, part, item, value, rank)} by the definition, with Python's whole numbers."""
    found = set()
    rows = [(lang or "", source or "", TERM.findall(lower(text))) for lang, source, text in rows]
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        documents = Counter(t for r in own for t in set(r[2]))
        kept = sorted(t for t, n in documents.items() if n >= least)
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if documents[t] >= least)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        q = share(sum(counts.values(), Counter()))
        p = {s: share(c) for s, c in counts.items()}
        for s in p:
            pair = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in p if o != s))
            term = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])[:ranks]
            for part, listed in (("pair", pair), ("term", term)):
                found |= {(lang, s, part, item.decode(), -value, i) for i, (value, item) in enumerate(listed, 1)}
    return found


def sample():
    r = random.Random(5)
    rows = []
    for i in range(160):
        lang, source = r.choice(["en", "de", None, ""]), r.choice(["a", "b", "é", None, "zz"])
        rows.append((lang, source, prose(r.randint(0, 60), i, 60) + r.choice([" Aé_b 9x", " ÀÉ ", "\u0000Q", ""])))
    rows += [("en", "a", None), ("en", "only empty", ""), ("fr", "x", "seen once"), ("fr", "y", None), (None, None, None)]
    return rows + rows[:7] + [("en", "a", prose(9_000, 1, 60))]


@pytest.mark.parametrize("leaves, part, cells, slab", [(divergence.LEAVES, divergence.PART, divergence.CELLS, divergence.SLAB), (20, 7, 12, 2)])
def test_equals_brute_force_also_with_tiny_tries_parts_and_slabs(spark, monkeypatch, leaves, part, cells, slab):
    monkeypatch.setattr(divergence, "BATCH_BYTES", 2_000 if slab == 2 else divergence.BATCH_BYTES)
    monkeypatch.setattr(divergence, "PART", part)
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "SLAB", slab)
    monkeypatch.setattr(divergence.count_terms, "__defaults__", (leaves,))
    rows = sample()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS term", "1.5 AS part", "'y' AS value", "'z' AS total")
    got = [tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.audit(docs.repartition(3), 6, 4).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_force(rows, 6, 4)


def test_empty_table_and_language_without_kept_terms(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    got = divergence.audit(spark.createDataFrame([("en", "a", "one"), ("en", "b", "two"), ("de", "c", "three")], SCHEMA)).collect()
    assert sorted((r["lang"], r["source"], r["item"], r["value"], r["rank"]) for r in got) == [("en", "a", "b", 0, 1), ("en", "b", "a", 0, 1)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=6), max_size=40))
def test_trie_walks_terms_in_byte_order(terms):
    trie = divergence.Trie()
    for t in terms:
        leaf = trie.leaf(t.encode())
        leaf[0] = leaf.get(0, 0) + 2
    walked = [(key.decode(), leaf[0]) for key, leaf in trie.walk()]
    want = Counter(terms)
    assert walked == [(t, 2 * want[t]) for t in sorted(want, key=str.encode)]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 8 * 10**12), st.integers(0, 10**12), st.integers(1, 10**9))
def test_shares_are_exact_beyond_what_one_product_holds(count, others, terms):
    got = divergence.shares(np.array([count]), np.array([count + others]), terms)[0]
    assert got == 1 + 10**9 * (count + 5) // (count + others + 5 * terms)
