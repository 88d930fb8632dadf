from __future__ import annotations

import tracemalloc
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from paytrail.llm import components, simhash
from paytrail.llm.common import Scratch

from .texts import DOCS, corpus, prose, words


def fingerprint(text, size=3):
    w = words(text)
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + size]).encode(), 42) for i in range(max(1, len(w) - size + 1))] if w else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def least_reachable(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_equals_brute_force(spark):
    rows = [(i, t) for i, t in corpus() if i is not None]
    got = {(r[0], r[1], r[2]) for r in simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()}
    prints = {t: fingerprint(t) for _, t in rows}
    ids = defaultdict(list)
    for i, t in rows:
        ids[prints[t]].append(i)
    root = least_reachable(ids, [(a, b) for a in ids for b in ids if a < b and (a ^ b).bit_count() <= 3])
    least = defaultdict(lambda: 1 << 60)
    for f, own in ids.items():
        least[root[f]] = min(least[root[f]], *own)
    assert got == {(i, format(prints[t], "016x"), least[root[prints[t]]]) for i, t in rows}


def test_null_identifiers_and_empty_table(spark):
    out = simhash.near_duplicates(spark.createDataFrame([(None, None), (None, "a b"), (3, "")], DOCS)).collect()
    assert sorted((r[0], r[1], r[2]) for r in out if r[0]) == [(3, "0" * 16, 3)]
    assert len(out) == 3
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("distance", [2, 3, 4, 6])
@pytest.mark.parametrize("n", [40, 40_000_000])
def test_plans_keep_the_pigeonhole_bound(distance, n):
    rng = np.random.default_rng(1)
    sample = rng.integers(0, 1 << 63, 300, dtype=np.uint64) & ~np.uint64(0xFF)  # eight bits that never vary
    plan = simhash.make_plan(sample, n, distance)
    assert sorted(b for p in plan.parts for b in p) == list(range(64))
    assert sum(plan.limits) == distance - len(plan.parts) + 1


@pytest.mark.parametrize("limits", [(0, 0, 0, 0), (1, 0, 0), (2, -1, 0, -1), (3,)])
def test_any_thresholds_of_that_sum_find_every_link(spark, limits):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = base.copy()
    for _ in range(3):
        near ^= np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)
    fps = np.unique(np.concatenate((base, near)))
    width = 64 // len(limits)
    parts = tuple(tuple(range(k * width, (k + 1) * width if k < len(limits) - 1 else 64)) for k in range(len(limits)))
    if limits == (3,):
        parts, limits = (tuple(range(32)), tuple(range(32, 64))), (1, 1)
    prints = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    edges = [tuple(r) for r in simhash.find_links(prints, simhash.Plan(parts, limits, 0.0), 3).collect()]
    nodes = [int(x) for x in fps.view(np.int64)]
    want = [(a, b) for a in nodes for b in nodes if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    assert least_reachable(nodes, edges) == least_reachable(nodes, want)


def test_large_values_give_a_spanning_forest():
    rng = np.random.default_rng(3)
    nodes = np.unique(np.uint64(7) ^ (np.uint64(1) << rng.integers(0, 64, 20_000, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 20_000, dtype=np.uint64)))
    edges = simhash.forest(nodes, 3)
    assert len(edges) < len(nodes)
    old, simhash.LARGE_RUN = simhash.LARGE_RUN, 64
    split = simhash.link_value(nodes, 3)
    simhash.LARGE_RUN = old
    as_pairs = lambda e: [(int(a), int(b)) for a, b in e]
    whole = [int(x) for x in nodes]
    assert least_reachable(whole, as_pairs(split)) == least_reachable(whole, as_pairs(edges))


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (60, 61), (61, 60), (50, 100)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(components.connected_components(df, Scratch(spark, "test")).collect())
    nodes = {n for e in edges for n in e}
    assert got == {n: (0 if n <= 50 or n >= 100 else 60) for n in nodes}


def test_near_copies_by_similarity(spark):
    rows = [(i, t) for i, t in corpus() if i is not None and len(words(t)) > 20]
    shingles = {t: {tuple(words(t)[i : i + 5]) for i in range(max(1, len(words(t)) - 4))} for _, t in rows}
    alike = lambda a, b: len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])
    root = least_reachable(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if alike(rows[i][1], rows[j][1])])
    groups = defaultdict(list)
    for i, r in root.items():
        groups[r].append(rows[i][0])
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in rows], DOCS + ", node string, stays long")
    out = simhash.drop_near_copies(docs, tables=3)
    assert out.columns == docs.columns
    assert sorted({r["doc_id"] for r in out.collect()}) == sorted(min(g) for g in groups.values())


def jaccard(a, b, size=5):
    a, b = ({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} for w in (a, b))
    return len(a & b) / len(a | b)


def kept_by_brute_force(rows):
    """Least identifiers of the groups that similar texts connect."""
    held = [words(t) for _, t in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in held]
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    root = least_reachable(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if alike(sets[i], sets[j])])
    return sorted({rows[r][0] for r in root.values()})


def edited_copies(n, seed, n_words=300, edits=8):
    """One text and n copies of it with so many words of their own, similar to it but not to each other."""
    rng = np.random.default_rng(seed)
    base = prose(n_words, seed, 3_000).split()
    rows = []
    for i in range(n):
        own = list(base)
        for at in rng.choice(np.arange(4, n_words - 5, 6), edits, replace=False):
            own[at] = f"own{seed}x{i}x{at}"
        rows.append(own)
    return base, rows


@pytest.mark.parametrize("block_texts", [100])
def test_copies_similar_to_one_text_only_are_one_group(spark, monkeypatch, block_texts):
    monkeypatch.setattr(simhash, "BLOCK_TEXTS", block_texts)
    base, copies = edited_copies(300, 21, edits=6)
    assert all(jaccard(base, c) >= 0.8 for c in copies)
    assert sum(jaccard(copies[0], c) >= 0.8 for c in copies[1:]) < 30
    rows = [(i, " ".join(c)) for i, c in enumerate(copies)] + [(900, " ".join(base))] + [(1_000 + i, prose(200, 5_000 + i, 3_000)) for i in range(20)]
    out = simhash.drop_near_copies(spark.createDataFrame(rows, DOCS))
    assert sorted(r["doc_id"] for r in out.collect()) == kept_by_brute_force(rows)


def test_similar_texts_among_reorderings_of_their_words(spark):
    """Texts of one set of words have one fingerprint; the two that are similar are found among thirty that aren't."""
    base = prose(200, 88, 3_000).split()
    other = base[:-2] + base[-1:] + base[-2:-1]
    assert jaccard(base, other) > 0.95
    rows = [(1, " ".join(base)), (2, " ".join(other))]
    for k in range(30):
        own = list(base)
        np.random.default_rng(k).shuffle(own)
        rows.append((10 + k, " ".join(own)))
    out = simhash.drop_near_copies(spark.createDataFrame(rows, DOCS))
    assert sorted(r["doc_id"] for r in out.collect()) == [1, *range(10, 40)] == kept_by_brute_force(rows)


def test_sketches_differ_no_more_than_sets():
    rng = np.random.default_rng(4)
    for n, m, both in ((50, 60, 30), (1_000, 900, 850), (40_000, 41_000, 39_000), (0, 3, 0)):
        pool = rng.integers(0, 1 << 63, n + m, dtype=np.uint64)
        x, y = pool[:n], np.concatenate((pool[:both], pool[n : n + m - both]))
        texts = []
        for own in (x, y):
            power = min(max(len(own).bit_length(), simhash.LEAST_SKETCH), simhash.MOST_SKETCH)
            cells = np.bincount((simhash.mix(own) & np.uint64((1 << power) - 1)).astype(np.int64), minlength=1 << power)
            texts.append(np.frombuffer(np.packbits((cells & 1).astype(np.uint8), bitorder="little").tobytes(), np.uint64)[None])
        power = min(t.shape[1] for t in texts).bit_length() + 5
        apart = int(np.bitwise_count(simhash.folded(texts[0], power) ^ simhash.folded(texts[1], power)).sum())
        assert apart <= n + m - 2 * both


def test_copies_with_an_edited_block_are_found(spark):
    rows, edited = [], []
    for i in range(30):
        base = prose(300, 7_000 + i, 3_000).split()
        new = [f"new{i}x{k}" for k in range(60)]
        at = 40 + 5 * i
        for k, own in enumerate((base + new, base[:at] + base[at + 50 :], base[:at] + new[:26] + base[at + 26 :])):
            assert 0.8 <= jaccard(base, own) < 0.85
            edited.append((1_000 + 10 * i + k, " ".join(own)))
        rows.append((i, " ".join(base)))
    out = simhash.drop_near_copies(spark.createDataFrame(rows + edited, DOCS))
    assert sorted(r["doc_id"] for r in out.collect()) == [i for i, _ in rows]


def test_the_plan_takes_little_memory_of_the_driver():
    """Pipeline: four tables are planned on the driver, beside Spark's own memory."""
    sample = np.random.default_rng(5).integers(0, 2**64, simhash.SAMPLE, dtype=np.uint64)
    tracemalloc.start()
    simhash.make_plan(sample, 10**6, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20, peak
    few = np.concatenate((sample[:150] & np.uint64(0xFF), sample[:3]))
    pairs = [int(a ^ b).bit_count() for a, b in combinations(few, 2)]
    assert list(simhash.near_pairs(few, 4)) == [pairs.count(d) for d in range(5)]
    assert list(simhash.near_pairs(few[:1], 2)) == [0, 0, 0]
