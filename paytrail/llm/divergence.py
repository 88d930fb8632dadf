"""Source divergence: how far the word shares of a language's sources lie apart, in whole numbers.

Terms are runs of letters (A-Z, a-z and all beyond ASCII), only A-Z lower-cased.

1. Every task counts terms into byte radix tries, one for each language; a leaf holds how
   often each source has the term, and in how many documents it is.  (A term that only one
   source of one batch has waits beside the trie, so that junk grows no branches.)  When
   the tries have LEAVES terms they are written out, and new ones begun, so memory is bounded.
2. Leaves are dealt by ranges of (language, term bytes), which splits prefixes as the data asks
   for.  Within a range, equal leaves follow one another and are merged as the range streams
   by; a very frequent term is no more than one leaf for each trie written.  Terms in
   fewer than ``least_documents`` documents of the language go.
3. Totals of sources and languages are sums over the kept leaves.
4. Kept leaves, in parts of PART terms, meet the totals of their language.  A part is a trie
   again; its traversal in UTF-8 order adds up the differences for each pair of sources, in
   slabs of bounded size, and streams each source's candidates, of which the best
   ``ranks`` leave the part (ties by the term's bytes).  Sums over parts and a ranked window give the answer.

A share is p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)), by long division
in steps, which no 64-bit number exceeds up to 9 * 10^15 words.

Defined results: null text, language and source are ''; a group without terms has all counts zero;
a language without kept terms gives pairs of value 0 and no terms; an empty table gives no
rows.  Columns other than text, lang and source are not read.
"""

from __future__ import annotations

import gc
import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .textkernels import batches

#: Letters stay (A-Z lower-cased) and so do all bytes of characters beyond ASCII; the rest parts terms.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
SCALE_STEPS, STEP = 3, 1000  # 10^9 in three steps
SMOOTH = 5
BATCH_BYTES = 4 << 20
#: Leaves of one written trie, terms of a part, and cells of the pair sums that a task holds.
LEAVES, PART, CELLS = 200_000, 20_000, 4 << 20
SLAB = 256
LEAF = "lang string, term binary, documents long, sources array<string>, counts array<long>"
LEAF_TYPE = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("documents", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
FOUND = "lang string, source string, part string, item string, value long"
FOUND_TYPE = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


class Node:
    """Edge bytes lead here; children by their first byte; what is counted here, if a term ends here."""

    __slots__ = ("edge", "children", "leaf")

    def __init__(self, edge: bytes):
        self.edge, self.children, self.leaf = edge, {}, None


class Trie:
    """A byte radix trie; a leaf is a counter for each source.  Leaves are remembered by term, so that only new terms walk down."""

    def __init__(self):
        self.root, self.known = Node(b""), {}

    def leaf(self, term: bytes) -> dict[int, int]:
        found = self.known.get(term)
        if found is None:
            found = self.known[term] = self._reach(term).leaf = {}
        return found

    def _reach(self, key: bytes) -> Node:
        node = self.root
        while key:
            child = node.children.get(key[0])
            if child is None:
                child = node.children[key[0]] = Node(key)
                return child
            edge = child.edge
            shared = _shared(edge, key)
            if shared < len(edge):  # the edge forks here
                fork = Node(edge[:shared])
                child.edge = edge[shared:]
                fork.children[child.edge[0]] = child
                node.children[key[0]] = child = fork
            node, key = child, key[shared:]
        return node

    def walk(self) -> Iterator[tuple[bytes, dict[int, int]]]:
        """Terms in the order of their bytes, which for UTF-8 is that of code points."""
        held = [(b"", self.root)]
        while held:
            before, node = held.pop()
            at = before + node.edge
            if node.leaf is not None:
                yield at, node.leaf
            held += ((at, node.children[b]) for b in sorted(node.children, reverse=True))


class Counts:
    """What a task has counted of one language: a trie, and the terms that wait for a second source or batch.

    Sources are numbered; what waits is one whole number, its source above LOW bits and its count.
    """

    LOW = 44

    def __init__(self):
        self.trie, self.waiting, self.documents, self.sources = Trie(), {}, Counter(), {}

    def add(self, source: str, occurrences: Counter) -> None:
        known, waiting, low = self.trie.known, self.waiting, self.LOW
        own = self.sources.setdefault(source, len(self.sources))
        for term, n in occurrences.items():
            leaf = known.get(term)
            if leaf is None:
                first = waiting.pop(term, None)
                if first is None:
                    waiting[term] = own << low | n
                    continue
                leaf = self.trie.leaf(term)
                leaf[first >> low] = first & ((1 << low) - 1)
            leaf[own] = leaf.get(own, 0) + n

    def rows(self, lang: str) -> Iterator[pa.RecordBatch]:
        names = pa.array(self.sources, pa.string())

        def batch(terms: list[bytes], ends: list[int], sources: list[int], counts: list[int]) -> pa.RecordBatch:
            limits = pa.array(ends, pa.int32())
            columns = [pa.array([lang] * len(terms)), pa.array(terms, pa.binary()), pa.array([self.documents[t] for t in terms], pa.int64())]
            columns += [pa.ListArray.from_arrays(limits, names.take(pa.array(sources, pa.int32()))), pa.ListArray.from_arrays(limits, pa.array(counts, pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, schema=LEAF_TYPE)

        terms, ends, sources, counts = [], [0], [], []
        for term, leaf in self.trie.walk():
            terms.append(term)
            sources += leaf
            counts += leaf.values()
            ends.append(len(sources))
            if len(terms) == 8192:
                yield batch(terms, ends, sources, counts)
                terms, ends, sources, counts = [], [0], [], []
        if terms:
            yield batch(terms, ends, sources, counts)
        waiting = sorted(self.waiting)
        for at in range(0, len(waiting), 8192):
            own = waiting[at : at + 8192]
            packed = np.array([self.waiting[t] for t in own], np.int64)
            yield batch(own, range(len(own) + 1), packed >> self.LOW, packed & ((1 << self.LOW) - 1))


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def _groups(docs: DataFrame) -> list:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def count_terms(docs: DataFrame, leaves: int = LEAVES) -> DataFrame:
    """The leaves of every task's tries."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counts] = {}
        gc.disable()  # tries have no cycles; the collector would only walk them over and over
        for batch in batches(stream, "text", BATCH_BYTES):
            found: dict[tuple[str, str], Counter] = {}
            for text, lang, source in zip(batch["text"].cast(pa.binary()).to_pylist(), batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True):
                terms = text.translate(LETTERS).split()
                if not terms:
                    continue
                if lang not in held:
                    held[lang] = Counts()
                held[lang].documents.update(set(terms))
                found.setdefault((lang, source), Counter()).update(terms)
            for (lang, source), occurrences in found.items():
                held[lang].add(source, occurrences)
            if sum(len(c.documents) for c in held.values()) >= leaves:
                for lang, own in held.items():
                    yield from own.rows(lang)
                held = {}
        for lang, own in held.items():
            yield from own.rows(lang)
        gc.enable()

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    return docs.select(text, *_groups(docs)).mapInArrow(run, LEAF)


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)


def merged(leaves: pa.Table) -> pa.Table:
    """Sorted leaves, equal ones as one."""
    leaves = leaves.combine_chunks()
    lang, term, documents, sources, counts = (leaves[c].chunk(0) for c in LEAF_TYPE.names)
    n = len(lang)
    new = np.ones(n, bool)
    new[1:] = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(new)
    owner = np.repeat(np.cumsum(new) - 1, pc.list_value_length(sources).to_numpy(zero_copy_only=False))
    coded = sources.flatten().dictionary_encode()
    pair = owner * max(len(coded.dictionary), 1) + coded.indices.to_numpy()
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    firsts = np.flatnonzero(np.diff(pair, prepend=-1))
    totals = np.add.reduceat(counts.flatten().to_numpy()[order], firsts)
    limits = pa.array(np.concatenate((np.searchsorted(owner[order][firsts], np.arange(len(starts))), [len(firsts)])), pa.int32())
    names = coded.dictionary.take(pa.array(pair[firsts] % max(len(coded.dictionary), 1)))
    columns = [lang.take(pa.array(starts)), term.take(pa.array(starts)), pa.array(np.add.reduceat(documents.to_numpy(), starts)), pa.ListArray.from_arrays(limits, names), pa.ListArray.from_arrays(limits, pa.array(totals))]
    return pa.Table.from_arrays(columns, schema=LEAF_TYPE)


def merge(leaves: DataFrame, least_documents: int) -> DataFrame:
    """(lang, term, sources, counts, place): leaves of equal terms as one, of those in enough documents.

    Places are in the order of ranges, and of at most PART terms each.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, done = TaskContext.get().partitionId() << 32, 0

        def kept(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal done
            rows = rows.filter(pc.greater_equal(rows["documents"], least_documents)).drop_columns("documents")
            place = pa.array(first + np.arange(done, done + len(rows)) // PART)
            done += len(rows)
            yield from rows.append_column("place", place).combine_chunks().to_batches()

        last = LEAF_TYPE.empty_table()
        for batch in stream:
            if batch.num_rows:
                own = merged(pa.concat_tables([last, pa.Table.from_batches([batch]).cast(LEAF_TYPE)]))
                last = own.slice(len(own) - 1)  # it may go on in the next batch
                yield from kept(own.slice(0, len(own) - 1))
        yield from kept(last)

    dealt = leaves.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    return dealt.mapInArrow(run, "lang string, term binary, sources array<string>, counts array<long>, place long")


def in_parts(kept: DataFrame) -> DataFrame:
    """kept with part in place of place: neighbouring places together, about PART terms each."""
    sizes = kept.groupBy("place").agg(F.count("*").alias("n"))  # a row for each range of the shuffle
    before = F.sum("n").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    parts = sizes.select("place", F.floor(F.coalesce(before, F.lit(0)) / PART).alias("part"))
    return kept.join(parts, "place").drop("place")


def shares(counts: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(10^9 (counts + SMOOTH) / (total + SMOOTH terms)), exact."""
    below = total + SMOOTH * terms
    rest, out = counts + SMOOTH, np.zeros(np.broadcast(counts, total).shape, np.int64)
    for _ in range(SCALE_STEPS):
        rest = rest * STEP
        out = out * STEP + rest // below
        rest = rest % below
    return out + 1


class Best:
    """The best candidates seen: greatest value first, of equal ones those that came first."""

    def __init__(self, n: int):
        self.n, self.heap = n, []

    def offer(self, value: int, order: int, term: str) -> None:
        entry = (value, -order, term)
        if len(self.heap) < self.n:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)


def compare_parts(kept: DataFrame, totals: DataFrame, ranks: int) -> DataFrame:
    """Each part's own pair sums and best terms; totals has (lang, source, total, terms) for every group."""

    def one_language(lang: str, leaves: list[dict], total_of: dict[str, int], terms: int) -> Iterator[pa.RecordBatch]:
        names = sorted(total_of)
        place = {s: i for i, s in enumerate(names)}
        total = np.array([total_of[s] for s in names], np.int64)
        best = {s: Best(ranks) for s in names}
        whole = int(total.sum())
        block = max(1, min(4096, CELLS // len(names)))
        sums: dict[int, np.ndarray] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for s0, part in sums.items():
                for i, row in enumerate(part):
                    n = len(names)
                    others = [j for j in range(n) if j != s0 + i]
                    if others:
                        yield pa.RecordBatch.from_arrays([pa.array([x] * (n - 1), pa.string()) for x in (lang, names[s0 + i], "pair")] + [pa.array([names[j] for j in others]), pa.array(row[others])], schema=FOUND_TYPE)

        for b in range(0, len(leaves), block):
            own = leaves[b : b + block]
            count = np.zeros((len(own), len(names)), np.int64)
            for i, leaf in enumerate(own):
                count[i, [place[s] for s in leaf["sources"]]] = leaf["counts"]
            p = shares(count, total[None, :], terms)
            q = shares(count.sum(axis=1), np.int64(whole), terms)
            ahead = (count > 0) & (p > q[:, None])
            texts = [leaf["term"].decode() for leaf in own]
            for j, name in enumerate(names):
                for i in np.flatnonzero(ahead[:, j]):
                    best[name].offer(int(p[i, j] - q[i]), b + int(i), texts[i])
            for s0 in range(0, len(names), SLAB):
                if s0 not in sums:
                    if held and held + SLAB * len(names) > CELLS:
                        yield from flush()
                        sums.clear()
                        held = 0
                    sums[s0] = np.zeros((min(SLAB, len(names) - s0), len(names)), np.int64)
                    held += sums[s0].size
                for i in range(sums[s0].shape[0]):
                    sums[s0][i] += np.abs(p - p[:, s0 + i : s0 + i + 1]).sum(axis=0)
        yield from flush()
        for name, own in best.items():
            if own.heap:
                yield _batch([(lang, name, "term", term, value) for value, _, term in own.heap], FOUND_TYPE)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total_of: dict[str, dict[str, int]] = {}
        terms: dict[str, int] = {}
        held: dict[str, list[dict]] = {}
        for batch in stream:
            for row in batch.to_pylist():
                if row["term"] is None:
                    total_of.setdefault(row["lang"], {})[row["sources"][0]] = row["counts"][0]
                    terms[row["lang"]] = row["terms"]
                else:
                    held.setdefault(row["lang"], []).append(row)
        for lang, own in held.items():
            own.sort(key=lambda leaf: leaf["term"])
            yield from one_language(lang, own, total_of[lang], terms[lang])

    columns = ("part", "lang", "term", "sources", "counts", "terms")
    leaves = kept.withColumn("terms", F.lit(None).cast("long")).select(*columns)
    # A part meets the totals of its languages as rows among its own: nothing is broadcast.
    spread = kept.select("part", "lang").distinct().join(totals, "lang")
    spread = spread.select("part", "lang", F.lit(None).cast("binary").alias("term"), F.array("source").alias("sources"), F.array("total").alias("counts"), "terms")
    return leaves.unionByName(spread).groupBy("part").applyInArrow(run, FOUND)


def audit(docs: DataFrame, least_documents: int = 30, ranks: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank) of docs (text, lang, source), as the module says."""
    scratch = Scratch(docs.sparkSession, "divergence")
    leaves = scratch.keep(count_terms(docs), "leaves")
    kept = scratch.keep(merge(leaves, least_documents), "kept")
    scratch.drop("leaves")
    # Every group there is, also those without kept terms.
    groups = docs.select(*_groups(docs)).distinct()
    counted = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("own")).groupBy("lang", F.col("own.sources").alias("source")).agg(F.sum("own.counts").alias("total"))
    terms = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    totals = groups.join(counted, ["lang", "source"], "left").join(terms, "lang", "left").na.fill(0, ["total", "terms"])
    totals = scratch.keep(totals, "totals")
    found = scratch.keep(compare_parts(in_parts(kept), totals.filter("terms > 0"), ranks), "found")
    none = totals.filter("terms = 0").select("lang", "source")
    empty = none.join(none.withColumnRenamed("source", "item"), "lang").filter("source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).unionByName(empty)
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    best = found.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ranks)
    return ranked.unionByName(best)
