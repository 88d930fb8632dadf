"""SimHash near-duplicates through a generalised pigeonhole index.

Two 64-bit fingerprints within distance T are, for bit partitions p1..pm and
thresholds t1..tm whose sum is T - m + 1, within ti on at least one partition
(ti = -1 leaves a partition out).  Correlated bits are put into one partition, and
m, the partitions and the thresholds are chosen by dynamic programming on the
numbers of probes and candidates that a bounded sample of fingerprints suggests.
The choice changes costs only: every true link is found whatever the sample is.

Fingerprints that occur in many documents are one node, so copies never meet in
pairs.  Each node is dealt to its partition values (and, where ti > 0, to the
values within ti); values are sorted within Spark partitions, and the nodes of
one value are verified against each other in arrays.  Only the edges of a
spanning forest leave a large value, so rows stay in proportion to nodes.
Components come from alternating stars over the edges.

Defined results: null and empty texts have no words and fingerprint zero, which
links like any other.  A component's number is its least non-null document
identifier (null if it has none).  Rows that repeat an identifier stay, with equal
results.  Texts of any length are read whole.  Columns beyond doc_id and text are not read, but
drop_near_copies() gives all, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower, without
from .components import connected_components
from .textkernels import LOWER, batches, gram_hashes, mix, split_words, word_hashes

BITS = 64
SEED = 42
#: Fingerprints that the choice of partitions looks at.
SAMPLE = 2048
#: Of which so many are compared with all at a time.
PLAN_ROWS = 64
#: Cost of verifying a candidate, of which dealing one row costs 1.
VERIFY_COST = 0.02
#: Values with at most so many nodes are compared offset by offset, with more by search.
SMALL_RUN = 16
#: Values with more nodes are split again by other bits.
LARGE_RUN = 8192
CHUNK = 65536


# -- fingerprints ---------------------------------------------------------------------------


def shingle_hashes(raw: bytes, words: int, distinct: bool = False) -> np.ndarray:
    """XXH64 of every shingle of the text's words, in order."""
    found = raw.translate(bytes(LOWER)).split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    if distinct:
        found = list(dict.fromkeys(found))
    joined = b" ".join(found)
    ends = np.cumsum([len(x) + 1 for x in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(words, len(found))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(found) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[s:e], SEED) for s, e in spans), dtype=np.uint64, count=len(found) - size + 1)


def majority(hashes: np.ndarray) -> int:
    """Bit i is set if it is in over half the hashes; none gives zero."""
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = np.ascontiguousarray(hashes[at : at + CHUNK])
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.uint64)[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, words: int = 3, distinct: bool = False, tables: int = 1) -> DataFrame:
    """(doc_id, prints array<long>): fingerprint k of a text remixes the shingle hashes with k."""
    kind = docs.schema["doc_id"].dataType

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            texts = batch.column("text").cast(pa.binary())
            flat = np.empty((batch.num_rows, tables), dtype=np.uint64)
            for i, raw in enumerate(texts):
                hashes = shingle_hashes(raw.as_py() or b"", words, distinct)
                for k in range(tables):
                    flat[i, k] = majority(hashes if k == 0 else mix(hashes + np.uint64(k)))
            offsets = pa.array(np.arange(0, flat.size + 1, tables), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(offsets, pa.array(flat.view(np.int64).ravel()))], names=["doc_id", "prints"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind.simpleString()}, prints array<long>")


# -- the plan -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """Bit partitions with a threshold each; their sum is the distance - partitions + 1."""

    parts: tuple[tuple[int, ...], ...]
    limits: tuple[int, ...]
    cost: float


def group_bits(sample: np.ndarray, m: int) -> list[tuple[int, ...]]:
    """m partitions of about equal size; each grows by the bit most correlated with it."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    spread = bits.std(axis=0)
    centred = (bits - bits.mean(axis=0)) / np.where(spread > 0, spread, 1)
    tie = np.abs(centred.T @ centred) / max(len(sample), 1)
    # A bit that never varies separates nothing: it counts as tied to all.
    tie[spread == 0, :] = tie[:, spread == 0] = 1
    np.fill_diagonal(tie, 0)
    left, out = set(range(BITS)), []
    for k in range(m):
        size = len(left) // (m - k)
        rest = sorted(left)
        held = [max(rest, key=lambda b: (tie[b, rest].max(), -b))]
        left.discard(held[0])
        while len(held) < size:
            rest = sorted(left)
            best = rest[int(np.argmax(tie[np.ix_(held, rest)].mean(axis=0)))]
            held.append(best)
            left.discard(best)
        out.append(tuple(sorted(held)))
    return out


def _choose(n: int, k: int) -> int:
    return reduce(lambda x, i: x * (n - i) // (i + 1), range(k), 1)


def near_pairs(prints: np.ndarray, most: int) -> np.ndarray:
    """How many pairs differ in 0, 1, ... most bits.  The driver asks this, so only some rows of the pairs are held at a time."""
    found = np.zeros(most + 1, dtype=np.int64)
    for at in range(0, len(prints), PLAN_ROWS):
        apart = np.bitwise_count(prints[at : at + PLAN_ROWS, None] ^ prints[None, :])
        found += [np.count_nonzero(apart == d) for d in range(most + 1)]
    found[0] -= len(prints)  # each with itself
    return found // 2


def make_plan(sample: np.ndarray, n: int, distance: int) -> Plan:
    """The cheapest plan for n distinct fingerprints, by estimated probes and candidates."""
    best: Plan | None = None
    if not len(sample):  # an empty table
        sample = np.zeros(1, dtype=np.uint64)
    n = max(n, 2)  # for fewer, all plans would cost nothing
    pairs = max(len(sample) * (len(sample) - 1) // 2, 1)
    for m in range(1, min(distance + 1, 6) + 1):
        parts = group_bits(sample, m)
        total = distance - m + 1
        costs = []
        for part in parts:
            w = len(part)
            mask = np.uint64(sum(1 << b for b in part))
            held = sample & mask
            near = near_pairs(held, total)
            even = np.array([_choose(w, d) / 2.0**w for d in range(total + 1)])
            share = np.cumsum(near / pairs + even)  # what is seen, and what independent bits would give
            probes = [0.0] + [n * sum(_choose(w, d) for d in range(t + 1)) for t in range(total + 1)]
            costs.append([0.0] + [probes[t + 1] + VERIFY_COST * share[t] * n * n / 2 for t in range(total + 1)])
        # least[s]: cheapest thresholds of the parts so far with sum s; sums start at -parts
        least: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
        for part, cost in zip(parts, costs, strict=True):
            step: dict[int, tuple[float, tuple[int, ...]]] = {}
            for s, (c, chosen) in least.items():
                for t in range(-1, min(total, len(part)) + 1):
                    if s + t not in step or c + cost[t + 1] < step[s + t][0]:
                        step[s + t] = (c + cost[t + 1], (*chosen, t))
            least = step
        if total in least and (best is None or least[total][0] < best.cost):
            best = Plan(tuple(parts), least[total][1], least[total][0])
    assert best is not None
    return best


# -- probing and verifying --------------------------------------------------------------------


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def probe_rows(prints: DataFrame, plan: Plan) -> DataFrame:
    """(part, value, fp): the values of each fingerprint, and those within the partition's threshold."""
    probes = []
    for k, (part, limit) in enumerate(zip(plan.parts, plan.limits, strict=True)):
        if limit < 0:
            continue
        mask = _signed(sum(1 << b for b in part))
        flips = [_signed(sum(1 << b for b in chosen)) for d in range(limit + 1) for chosen in combinations(part, d)]
        probes += [(k, mask, flip) for flip in flips]
    deal = F.array(*(F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(mask)).bitwiseXOR(F.lit(flip)).alias("value")) for k, mask, flip in probes))
    return prints.select("fp", F.explode(deal).alias("p")).select("p.part", "p.value", "fp")


def forest(nodes: np.ndarray, distance: int) -> np.ndarray:
    """Edges of a spanning forest of the links among nodes."""
    left = np.ones(len(nodes), dtype=bool)
    edges = []
    waiting = np.arange(len(nodes))
    for seed in range(len(nodes)):
        if not left[seed]:
            continue
        left[seed] = False
        front = [seed]
        while front:
            at = front.pop()
            waiting = waiting[left[waiting]]
            near = waiting[np.bitwise_count(nodes[waiting] ^ nodes[at]) <= distance]
            if len(near):
                left[near] = False
                edges.append(np.stack((np.full(len(near), nodes[at]), nodes[near]), axis=1))
                front.extend(near.tolist())
    return np.concatenate(edges) if edges else np.zeros((0, 2), dtype=np.uint64)


def link_value(nodes: np.ndarray, distance: int, depth: int = 0) -> np.ndarray:
    """forest(), with a large value split by distance + 1 blocks of bits: a link agrees on one of them."""
    if len(nodes) <= LARGE_RUN or depth == 4:
        return forest(nodes, distance)
    blocks, out = distance + 1, []
    width = BITS // blocks
    turned = (nodes << np.uint64(7 * depth)) | (nodes >> np.uint64((64 - 7 * depth) % 64)) if depth else nodes
    for k in range(blocks):
        size = width if k < blocks - 1 else BITS - width * (blocks - 1)
        value = (turned >> np.uint64(width * k)) & np.uint64((1 << size) - 1)
        order = np.argsort(value, kind="stable")
        cuts = np.flatnonzero(np.diff(value[order])) + 1
        for run in np.split(order, cuts):
            if len(run) > 1:
                out.append(link_value(nodes[run], distance, depth + 1))
    return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), dtype=np.uint64)


def link_sorted(part: np.ndarray, value: np.ndarray, fp: np.ndarray, distance: int) -> np.ndarray:
    """Edges within each run of equal (part, value)."""
    fresh = np.ones(len(fp), dtype=bool)
    fresh[1:] = (part[1:] != part[:-1]) | (value[1:] != value[:-1])
    starts = np.append(np.flatnonzero(fresh), len(fp))
    sizes = np.diff(starts)
    out = []
    run = np.repeat(np.arange(len(sizes)), sizes)
    small = sizes[run] <= SMALL_RUN
    s_run, s_fp = run[small], fp[small]
    for step in range(1, SMALL_RUN):
        if len(s_run) <= step:
            break
        same = s_run[step:] == s_run[:-step]
        if not same.any():
            break
        i = np.flatnonzero(same)
        a, b = s_fp[i], s_fp[i + step]
        hit = np.bitwise_count(a ^ b) <= distance
        out.append(np.stack((a[hit], b[hit]), axis=1))
    for k in np.flatnonzero(sizes > SMALL_RUN):
        at = slice(starts[k], starts[k + 1])
        out.append(link_value(fp[at], distance))
    return np.concatenate(out) if out else np.zeros((0, 2), dtype=np.uint64)


def find_links(prints: DataFrame, plan: Plan, distance: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all that lie within distance."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def done(columns: list[np.ndarray]) -> pa.RecordBatch:
            edges = link_sorted(columns[0], columns[1], columns[2].view(np.uint64), distance).view(np.int64)
            edges = edges[edges[:, 0] != edges[:, 1]]
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(edges[:, i])) for i in (0, 1)], names=["a", "b"])

        for batch in stream:
            if not batch.num_rows:
                continue
            held.append([batch.column(n).to_numpy(zero_copy_only=False) for n in ("part", "value", "fp")])
            columns = [np.concatenate(x) for x in zip(*held, strict=True)] if (held[0][0][0], held[0][1][0]) != (held[-1][0][-1], held[-1][1][-1]) else None
            if columns:  # all but the last value are complete
                last = np.flatnonzero((columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1]))[0]
                yield done([x[:last] for x in columns])
                held = [[x[last:] for x in columns]]
        if held:
            yield done([np.concatenate(x) for x in zip(*held, strict=True)])

    rows = probe_rows(prints, plan)
    width = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(width, "part", "value").sortWithinPartitions("part", "value", "fp").mapInArrow(run, "a long, b long")


def linked(prints: DataFrame, distance: int) -> DataFrame:
    """Edges between the fingerprints in prints (fp, distinct)."""
    n = prints.count()
    picked = prints.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()
    sample = np.array([r[0] for r in picked], dtype=np.int64).view(np.uint64)
    return find_links(prints, make_plan(sample, n, distance), distance)


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs (doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "simhash")
    found = scratch.keep(fingerprints(docs, words).select("doc_id", F.col("prints")[0].alias("fp")), "fingerprints")
    prints = scratch.keep(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "prints")
    roots = connected_components(linked(prints, distance), scratch)
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("least_id"))
    moved = rooted.select("fp", "root").join(least, "root").select("fp", "least_id")
    named = scratch.keep(prints.join(moved, "fp", "left").select("fp", F.coalesce("least_id", "first_id").alias("component_id")), "named")
    return found.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# -- near copies by verified similarity -----------------------------------------------------------

#: Texts whose shingles may be found through a broadcast of their keys, 8 bytes each.
BROADCAST_TEXTS = 500_000


def text_node(text: Column) -> Column:
    """64-bit key of the lower-cased text."""
    return F.xxhash64(ascii_lower(text))


def candidate_links(docs: DataFrame, scratch: Scratch, tables: int, distance: int) -> DataFrame:
    """Links (a, b) between the keys of texts that some table of fingerprints has within distance.

    Fingerprints are of the set of a text's words, which an edited word changes least;
    texts of one fingerprint are linked to the least of them.
    """
    marked = docs.select(text_node(F.col("text")).alias("doc_id"), "text")
    found = scratch.keep(fingerprints(marked, 1, True, tables), "fingerprints")
    links = []
    for k in range(tables):
        own = found.select(F.col("doc_id").alias("node"), F.col("prints")[k].alias("fp"))
        prints = scratch.keep(own.groupBy("fp").agg(F.min("node").alias("first"), F.max("node").alias("last")), f"prints{k}")
        shared = prints.filter("first <> last")
        links.append(own.join(shared, "fp").filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")))
        near = scratch.keep(linked(prints, distance), f"near{k}")
        first = prints.select("fp", "first")
        ends = near.join(first.withColumnsRenamed({"fp": "a", "first": "x"}), "a").join(first.withColumnsRenamed({"fp": "b", "first": "y"}), "b")
        links.append(ends.select(F.col("x").alias("a"), F.col("y").alias("b")))
    every = reduce(DataFrame.unionByName, links).filter("a <> b")
    return scratch.keep(every.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "candidates")


def sets_of(stream: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """For batches of texts (node, text): the nodes, and the distinct word shingles of each as sorted hashes; a shorter text is one."""
    for batch in batches(stream, "text", 1 << 20):
        found = split_words(batch["text"])
        hashes = word_hashes(found)
        grams = gram_hashes(hashes, words)
        sets = []
        for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
            own = grams[a : b - words + 1] if b - a >= words else gram_hashes(hashes[a:b], b - a) if b > a else grams[:0]
            sets.append(np.unique(own))
        yield batch["node"].combine_chunks(), sets


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, shingles): the distinct word shingles of each text as sorted 64-bit hashes."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, sets in sets_of(stream, words):
            yield pa.RecordBatch.from_arrays([node, pa.array([x.tobytes() for x in sets], pa.binary())], names=["node", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "node long, shingles binary")


#: Powers of two of bits that a sketch has at least and at most.
LEAST_SKETCH, MOST_SKETCH = 6, 14


def folded(bits: np.ndarray, power: int) -> np.ndarray:
    """Sketches (rows of uint64) with 2**power bits, by adding up their halves."""
    while bits.shape[1] > 1 << power - 6:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def shingle_sketches(texts: DataFrame, words: int) -> DataFrame:
    """(node, n, bits): number of a text's distinct shingles, and for each of 2**k cells whether an odd number of them is in it.

    Cells in which two sketches differ hold a shingle that one set lacks, so sets differ
    in at least as many shingles.  A sketch has about a bit for each shingle.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, sets in sets_of(stream, words):
            sizes, bits = [], []
            for own in sets:
                power = min(max(int(len(own)).bit_length(), LEAST_SKETCH), MOST_SKETCH)
                cells = np.bincount((mix(own) & np.uint64((1 << power) - 1)).astype(np.int64), minlength=1 << power)
                sizes.append(len(own))
                bits.append(np.packbits((cells & 1).astype(np.uint8), bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([node, pa.array(sizes, pa.int32()), pa.array(bits, pa.binary())], names=["node", "n", "bits"])

    return texts.select("node", "text").mapInArrow(run, "node long, n int, bits binary")


def most_apart(n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """Shingles in which similar sets of n and m may differ at most."""
    return (n + m) * (1 - similarity) / (1 + similarity) + 1e-6


def possible_links(links: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """The links (a, b) whose sketches leave such a similarity possible."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(s.as_py(), np.uint64)[None] for s in (x, y))
                power = min(x.shape[1], y.shape[1]).bit_length() + 5
                keep.append(int(np.bitwise_count(folded(x, power) ^ folded(y, power)).sum()))
            yield batch.select(["a", "b"]).filter(pa.array(np.array(keep) <= most_apart(n, m, similarity)))

    x, y = (sketches.select(F.col("node").alias(c), F.col("n").alias(n), F.col("bits").alias(s)) for c, n, s in (("a", "n", "x"), ("b", "m", "y")))
    pairs = links.join(x, "a").join(y, "b").filter(F.least("n", "m") >= similarity * F.greatest("n", "m") - 1e-6)
    return pairs.select("a", "b", "n", "m", "x", "y").mapInArrow(run, "a long, b long")


def text_sets(nodes: DataFrame, docs: DataFrame, scratch: Scratch, words: int, name: str) -> DataFrame:
    """shingle_sets() of the texts whose keys are in nodes."""
    few = F.broadcast(nodes) if nodes.count() <= BROADCAST_TEXTS else nodes
    texts = docs.select(text_node(F.col("text")).alias("node"), F.coalesce("text", F.lit("")).alias("text")).join(few, "node", "left_semi").dropDuplicates(["node"])
    return scratch.keep(shingle_sets(texts, words), name)


def similar_links(links: DataFrame, sketches: DataFrame, docs: DataFrame, scratch: Scratch, words: int, similarity: float, name: str = "links") -> DataFrame:
    """The links (a, b) whose texts have so great a Jaccard similarity of word shingles."""
    links = scratch.keep(possible_links(links, sketches, similarity), f"{name}-possible")
    nodes = scratch.keep(links.select(F.col("a").alias("node")).union(links.select("b")).distinct(), f"{name}-nodes")
    sets = text_sets(nodes, docs, scratch, words, f"{name}-sets")

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x, y = sets.withColumnsRenamed({"node": "a", "shingles": "x"}), sets.withColumnsRenamed({"node": "b", "shingles": "y"})
    pairs = links.join(x, "a").join(y, "b")
    found = scratch.keep(pairs.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), name)
    scratch.drop(f"{name}-possible", f"{name}-nodes", f"{name}-sets")
    return found


# -- the links that no fingerprint tells of -----------------------------------------------------

#: Texts that the order of shingles looks at, and the shingles of them that are put last at most.
ORDER_TEXTS, LAST_SHINGLES = 16_384, 500_000
#: A shingle that more than one in so many sampled texts hold is hot: its list is never gathered in one task.
HOT_SHARE = 256
#: Lists with at most so many texts are compared pair by pair, longer ones in bundles.
SHORT_LIST = 4
#: Texts, and shingles of them, of one block of a bundle.
BLOCK_TEXTS, BLOCK_SHINGLES = 2_048, 300_000
#: Shingles' lists and bundles that may be broadcast, some 40 bytes each.
BROADCAST_LISTS = 500_000


def frequent_shingles(texts: DataFrame, words: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, counts) of the shingles that several of a bounded sample of texts hold."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in sets_of(stream, words):
            keys, often = np.unique(np.concatenate(held), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(often)], names=["key", "n"])

    sample = texts.filter(F.pmod(F.xxhash64("node"), F.lit(n // ORDER_TEXTS + 1)) == 0)
    counts = sample.select("node", "text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 2")
    rows = counts.orderBy(F.desc("n"), "key").limit(LAST_SHINGLES).toArrow()
    keys, often = (rows[c].to_numpy() for c in ("key", "n"))
    order = np.argsort(keys.view(np.uint64))
    return keys.view(np.uint64)[order], often[order]


def prefix_rows(texts: DataFrame, words: int, similarity: float, last: tuple[np.ndarray, np.ndarray], sampled: int) -> DataFrame:
    """(key, node, n, moved, hot): of each text's n shingles, in one order for all texts, the first n - ceil(similarity n) + 1.

    Two texts of that similarity share at least ceil(similarity n) of either's shingles,
    so one of those that the rows list.  The order puts frequent shingles last; it changes
    costs only.  texts has node, text and moved; sampled texts gave the frequencies last.
    """
    common, often = last

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, "text", 1 << 20):
            found = split_words(batch["text"])
            hashes = word_hashes(found)
            grams = gram_hashes(hashes, words)
            first = found.first
            long = np.flatnonzero(np.diff(first) >= words)
            short = np.flatnonzero(np.diff(first) < words)
            sizes = np.diff(first)[long] - words + 1
            at = np.repeat(first[long] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            ones = [gram_hashes(hashes[first[i] : first[i + 1]], int(first[i + 1] - first[i]))[0] if first[i + 1] > first[i] else np.uint64(0) for i in short]
            keys = np.concatenate((grams[at], np.array(ones, dtype=np.uint64)))
            owner = np.concatenate((np.repeat(long, sizes), short))
            weight = np.zeros(len(keys), dtype=np.int64)
            if len(common):
                place = np.minimum(np.searchsorted(common, keys), len(common) - 1)
                weight = np.where(common[place] == keys, often[place], 0)
            order = np.lexsort((keys, weight, owner))
            keys, owner = keys[order], owner[order]
            fresh = np.ones(len(keys), dtype=bool)
            fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
            keys, owner, weight = keys[fresh], owner[fresh], weight[order][fresh]
            n = np.bincount(owner, minlength=len(first) - 1)
            listed = n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1
            keep = np.arange(len(keys)) - (np.cumsum(n) - n)[owner] < listed[owner]
            keys, owner, weight = keys[keep], owner[keep], weight[keep]
            node, moved = (batch[c].combine_chunks().to_numpy(zero_copy_only=False)[owner] for c in ("node", "moved"))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(node), pa.array(n[owner].astype(np.int32)), pa.array(moved), pa.array(weight > sampled // HOT_SHARE)], names=["key", "node", "n", "moved", "hot"])

    return texts.select("node", "text", "moved").mapInArrow(run, "key long, node long, n int, moved long, hot boolean")


LISTED = "a long, b long, n int"


def list_candidates(rows: DataFrame, similarity: float) -> DataFrame:
    """What the lists of rows (key, node, n, moved) tell: pairs (a, b) to compare, n null, and members a with n shingles of bundle b.

    A list whose texts are of one group (node xor moved) tells nothing.  Every pair of a
    short list is told, unless its groups are the same or its sizes too far apart.  A longer list
    belongs to the bundle of its least node, so that the many lists of a family of
    copies become one; besides, each of its groups is tried once with that of the least node.
    """

    def done(key: np.ndarray, node: np.ndarray, n: np.ndarray, group: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.diff(key)) + 1
        starts = np.concatenate(([0], cuts))
        size = np.diff(np.concatenate((starts, [len(key)])))
        of = np.repeat(np.arange(len(size)), size)
        mixed = np.maximum.reduceat(group, starts) != np.minimum.reduceat(group, starts)
        pairs = []
        use = (mixed & (size <= SHORT_LIST))[of]
        s_of, s_node, s_n, s_group = of[use], node[use], n[use], group[use]
        for step in range(1, SHORT_LIST):
            i = np.flatnonzero(s_of[step:] == s_of[:-step]) if len(s_of) > step else np.zeros(0, np.int64)
            j = i + step
            fits = (s_group[i] != s_group[j]) & (np.minimum(s_n[i], s_n[j]) >= similarity * np.maximum(s_n[i], s_n[j]) - 1e-9)
            pairs.append(np.stack((s_node[i][fits], s_node[j][fits]), axis=1))
        long = mixed & (size > SHORT_LIST)
        use = long[of]
        l_of, l_node, l_n, l_group = of[use], node[use], n[use], group[use]
        least = np.minimum.reduceat(node, starts)
        head = least[l_of]
        # One text of each group of a list, another one for each key, with one of the least node's group.
        pick = np.lexsort((mix((l_node ^ key[use]).view(np.uint64)), l_group, l_of))
        first = np.ones(len(pick), dtype=bool)
        first[1:] = (l_of[pick][1:] != l_of[pick][:-1]) | (l_group[pick][1:] != l_group[pick][:-1])
        chosen = pick[first]
        own = np.zeros(len(size), dtype=np.int64)
        own[l_of[l_node == head]] = l_group[l_node == head]
        partner = np.zeros(len(size), dtype=np.int64)
        with_head = chosen[l_group[chosen] == own[l_of[chosen]]]
        partner[l_of[with_head]] = l_node[with_head]
        sizes = np.zeros(len(size), dtype=np.int64)
        sizes[l_of[with_head]] = l_n[with_head]
        others = chosen[l_group[chosen] != own[l_of[chosen]]]
        with_size = sizes[l_of[others]]
        others = others[np.minimum(l_n[others], with_size) >= similarity * np.maximum(l_n[others], with_size) - 1e-9]
        pairs.append(np.stack((l_node[others], partner[l_of[others]]), axis=1))
        pair = np.concatenate(pairs)
        pair = np.unique(np.stack((pair.max(axis=1), pair.min(axis=1)), axis=1), axis=0) if len(pair) else pair
        member, at = np.unique(np.stack((l_node, head), axis=1), axis=0, return_index=True) if len(l_node) else (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
        a, b = (np.concatenate((pair[:, k], member[:, k])) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.concat_arrays([pa.nulls(len(pair), pa.int32()), pa.array(l_n[at].astype(np.int32))])], names=["a", "b", "n"])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in stream:
            if not batch.num_rows:
                continue
            key, node, n, moved = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "node", "n", "moved"))
            held.append([key, node, n, node ^ moved])
            if held[0][0][0] == key[-1]:
                continue
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            cut = int(np.searchsorted(columns[0], key[-1]))  # all but the last list are complete
            yield done(*(x[:cut] for x in columns))
            held = [[x[cut:] for x in columns]]
        if held:
            yield done(*(np.concatenate(x) for x in zip(*held, strict=True)))

    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select("key", "node", "n", "moved").repartition(width, "key").sortWithinPartitions("key").mapInArrow(run, LISTED)


def hot_candidates(rows: DataFrame) -> DataFrame:
    """list_candidates() of hot shingles, of which there is a bounded number, by aggregation: no list is gathered."""
    grouped = rows.withColumn("group", F.col("node").bitwiseXOR(F.col("moved")))
    groups = grouped.groupBy("key", "group").agg(F.min("node").alias("least"), F.min_by("node", F.xxhash64("node", "key")).alias("one"))
    heads = groups.groupBy("key").agg(F.min("least").alias("head"), F.min_by(F.struct("group", "one"), "least").alias("own"), F.count("*").alias("n_groups")).filter("n_groups > 1")
    heads = F.broadcast(heads.select("key", "head", "own"))
    pairs = groups.join(heads, "key").filter(F.col("group") != F.col("own.group"))
    pairs = pairs.select(F.greatest("one", "own.one").alias("a"), F.least("one", "own.one").alias("b"), F.lit(None).cast("int").alias("n")).distinct()
    return pairs.unionByName(rows.join(heads, "key").select(F.col("node").alias("a"), F.col("head").alias("b"), "n").distinct())


def joining_links(nodes: np.ndarray, groups: np.ndarray, asked: np.ndarray, sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Links between similar texts of different groups, one of them asked, enough to join all groups that have any such."""
    sizes = np.array([len(s) for s in sets])
    _, token, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    by = owner[np.argsort(token, kind="stable")]
    begin, first = np.cumsum(often) - often, np.cumsum(sizes) - sizes
    _, group = np.unique(groups, return_inverse=True)
    links = []
    # Texts that share most with all others are asked first: they join most.
    order = np.argsort(-np.add.reduceat(often[token], first), kind="stable")
    for x in order[asked[order]]:
        if group.min() == group.max():
            break
        own = token[first[x] : first[x] + sizes[x]]
        own = own[often[own] > 1]
        count = often[own]
        at = np.repeat(begin[own] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        both = np.bincount(by[at], minlength=len(sets))
        near = np.flatnonzero((both >= similarity * (sizes + sizes[x] - both) - 1e-9) & (group != group[x]))
        if len(near):
            _, one = np.unique(group[near], return_index=True)
            links += [(nodes[x], nodes[y]) for y in near[one]]
            group[np.isin(group, group[near])] = group[x]
    return np.array(links, dtype=np.int64).reshape(-1, 2)


def possible_nodes(nodes: np.ndarray, groups: np.ndarray, asked: np.ndarray, n: np.ndarray, sketches: list[np.ndarray], similarity: float) -> np.ndarray:
    """Of the nodes, those that by their sketches may be similar to one of another group, one of the two being asked."""
    power = np.array([len(x).bit_length() + 5 for x in sketches])
    out = np.zeros(len(nodes), dtype=bool)
    for k in np.unique(power):
        # Similar sets have sizes so close that their sketches' powers are the same or next to each other.
        at = np.flatnonzero((power == k) | (power == k + 1))
        bits = np.concatenate([folded(sketches[i][None], int(k)) for i in at])
        for i in np.flatnonzero(asked[at]):
            x = at[i]
            near = (groups[at] != groups[x]) & ((power[at] == k) | (power[x] == k)) & (np.minimum(n[at], n[x]) >= similarity * np.maximum(n[at], n[x]) - 1e-6)
            j = np.flatnonzero(near)
            j = j[np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1) <= most_apart(n[at[j]], n[x], similarity)]
            if len(j):
                out[x] = True
                out[at[j]] = True
    return out


def small(df: DataFrame, most: int) -> DataFrame:
    """df, which is a written table, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= most else df


def bundle_blocks(members: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """(head, i, j, node, group, asked): the comparisons of the bundles members (head, node, n) that have several groups.

    Texts of a bundle's largest group needn't be compared with each other, so the others,
    dealt to blocks i, are asked against all, dealt to blocks j.  What is dealt twice stays in
    proportion to the bundle as long as one group holds most of it.
    """
    grouped = scratch.keep(members.join(small(roots.filter("node <> root"), BROADCAST_TEXTS), "node", "left").select("head", "node", "n", F.coalesce("root", "node").alias("group")), "members")
    groups = grouped.groupBy("head", "group").agg(F.count("*").alias("texts"), F.sum("n").alias("shingles"))
    most = F.max(F.struct("texts", "shingles", "group"))
    bundles = groups.groupBy("head").agg(F.count("*").alias("n_groups"), F.sum("texts").alias("texts"), F.sum("shingles").alias("shingles"), most.alias("most")).filter("n_groups > 1")
    blocks = lambda texts, shingles: F.greatest(F.ceil(texts / BLOCK_TEXTS), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1)).cast("int")
    bundles = scratch.keep(
        bundles.select("head", F.col("most.group").alias("main"), blocks(F.col("texts") - F.col("most.texts"), F.col("shingles") - F.col("most.shingles")).alias("n_i"), blocks(F.col("texts"), F.col("shingles")).alias("n_j")), "bundles"
    )
    rows = grouped.join(small(bundles, BROADCAST_LISTS), "head")
    place = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = rows.filter("group <> main").select("head", place(1, F.col("n_i")).alias("i"), every("n_j").alias("j"), "node", "group", F.lit(True).alias("asked"))
    others = rows.select("head", every("n_i").alias("i"), place(2, F.col("n_j")).alias("j"), "node", "group", F.lit(False).alias("asked"))
    return scratch.keep(asked.unionByName(others).groupBy("head", "i", "j", "node").agg(F.first("group").alias("group"), F.max("asked").alias("asked")), "blocks")


def remaining_links(docs: DataFrame, texts: DataFrame, sketches: DataFrame, links: DataFrame, scratch: Scratch, words: int, similarity: float) -> DataFrame:
    """links (a, b) between texts (node, text), and those between similar texts that join all groups of them which have any such texts.

    No pair is missed: each is in a list of prefix_rows().
    """
    roots = scratch.keep(connected_components(links, scratch), "early")
    moved = scratch.keep(roots.filter("node <> root").select("node", F.col("node").bitwiseXOR(F.col("root")).alias("moved")), "moved")
    distinct = sketches.count()
    last = frequent_shingles(texts, words, distinct)
    texts = texts.join(small(moved, BROADCAST_TEXTS), "node", "left").select("node", "text", F.coalesce("moved", F.lit(0).cast("long")).alias("moved"))
    rows = scratch.keep(prefix_rows(texts, words, similarity, last, distinct // (distinct // ORDER_TEXTS + 1)), "prefixes")
    found = scratch.keep(list_candidates(rows.filter("not hot"), similarity).unionByName(hot_candidates(rows.filter("hot"))), "listed")
    scratch.drop("prefixes")
    pairs = scratch.keep(found.filter("n is null").select("a", "b").distinct(), "pairs")
    links = scratch.keep(links.unionByName(similar_links(pairs, sketches, docs, scratch, words, similarity, "late")), "most-links")
    members = found.filter("n is not null").groupBy(F.col("b").alias("head"), F.col("a").alias("node")).agg(F.max("n").alias("n"))
    blocks = bundle_blocks(members, connected_components(links, scratch, "most-components"), scratch)

    def sift(table: pa.Table) -> pa.Table:
        node, group, asked, n = (table[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("node", "group", "asked", "n"))
        bits = [np.frombuffer(s.as_py(), np.uint64) for s in table["bits"]]
        keep = possible_nodes(node, group, asked.astype(bool), n, bits, similarity)
        return table.select(["head", "i", "j", "node", "group", "asked"]).filter(pa.array(keep))

    blocks = blocks.join(sketches, "node").groupBy("head", "i", "j").applyInArrow(sift, "head long, i int, j int, node long, group long, asked boolean")
    blocks = scratch.keep(blocks, "possible")
    nodes = scratch.keep(blocks.select("node").distinct(), "long-nodes")
    sets = text_sets(nodes, docs, scratch, words, "long-sets")

    def compare(table: pa.Table) -> pa.Table:
        node, group, asked = (table[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("node", "group", "asked"))
        held = [np.frombuffer(s.as_py(), np.uint64) if len(s.as_py()) else np.zeros(1, np.uint64) for s in table["shingles"]]
        found = joining_links(node, group, asked.astype(bool), held, similarity)
        return pa.table({"a": found[:, 0].copy(), "b": found[:, 1].copy()})

    late = scratch.keep(blocks.join(sets, "node").groupBy("head", "i", "j").applyInArrow(compare, "a long, b long"), "long")
    return links.unionByName(late)


def near_copy_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, tables: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, node, stays) of each row in a group of equal or similar texts; one row's document stays, that of the least identifier.

    Texts are similar if the Jaccard similarity of their word shingles reaches
    similarity; groups are connected by similar texts.  Fingerprints connect most of
    them; what they don't tell of is found by shared shingles, and none is missed.
    """
    scratch = Scratch(docs.sparkSession, "near-copies")
    texts = docs.select(text_node(F.col("text")).alias("node"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n, distinct = texts.agg(F.count("*"), F.count_distinct("node")).first()
    if distinct < n:
        texts = texts.dropDuplicates(["node"])
    sketches = scratch.keep(shingle_sketches(texts, words), "sketches")
    links = similar_links(candidate_links(docs, scratch, tables, distance), sketches, docs, scratch, words, similarity)
    links = remaining_links(docs, texts, sketches, links, scratch, words, similarity)
    roots = scratch.keep(connected_components(links, scratch, "all-components"), "roots")
    rows = docs.select("doc_id", text_node(F.col("text")).alias("node")).join(roots, "node", "left").select("doc_id", "node", F.coalesce("root", "node").alias("group"))
    groups = rows.groupBy("group").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")).filter("n > 1")
    return rows.join(groups, "group").select("doc_id", "node", F.col("doc_id").eqNullSafe(F.col("least_id")).alias("stays"))


def drop_near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, tables: int = 4, distance: int = 4) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    gone = near_copy_groups(docs, words, similarity, tables, distance).filter("not stays").select("doc_id", F.col("node").alias("key"))
    return without(docs, gone, text_node(docs["text"]), Scratch(docs.sparkSession, "drop-near-copies"))
