"""Repeated passages through a sparse suffix array.

Suffixes are kept at content-selected positions only: a position is kept if the hash
of the GRAM words from there is the least of some WINDOW neighbouring ones.  Texts
that share a passage of WINDOW + GRAM - 1 words keep the same positions in it.

Suffixes whose first GRAM words occur once are done.  The others are classed by the
words around them, LEFT before and RIGHT from the position: suffixes of one class
repeat each other throughout.  Then one suffix of each class, where a gram has several
classes, is sorted by its words, compared with its neighbours and extended from the
position left and right; a second sort is by the words before it.  A match of LEAST words or
more counts, and goes back to all members of the class.

In the first order the longest match to the right of a suffix is that with a neighbour, in the
second the longest to the left.  Stretches of LEAST words that both lengths would allow,
but no neighbour shared, may be shared with a suffix further away: they are looked up by
hash among the suffixes of their gram.  So no repeated stretch of LEAST words is
missed.  The matches of a text are merged into spans.

Sorting is by range of all words around the position, so a gram of any number of occurrences
is spread over tasks; the rows at the limits of ranges are compared afterwards.

Words around a gram are compared by hashes of 32 bits, grams and classes by 64.

Defined results: null and empty texts have no spans.  A passage that occurs twice in
one text is repeated.  Rows that repeat identifier and text repeat each other.  Columns
beyond doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch
from .textkernels import BASE, BASE_INVERSE, batches, gram_hashes, mix, powers, split_words, word_hashes

GRAM, WINDOW, LEAST = 12, 39, 51
LEFT, RIGHT = WINDOW, LEAST
BATCH_BYTES = 1 << 20
#: Rows that may be broadcast: keys of 8 bytes, or positions of the suffixes to fetch.
BROADCAST_ROWS = 20_000
#: Masks have a bit for each number of words, up to LEFT, by which a stretch of LEAST words may begin before a position.
ALL_STARTS = (1 << LEFT + 1) - 1


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of x[i:i + width] at each i."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def kept_positions(grams: np.ndarray, owner: np.ndarray, chunk: int = 1 << 20) -> np.ndarray:
    """Minimiser positions: the (leftmost) least gram of each window of WINDOW grams within one text."""
    n = len(owner) - (WINDOW + GRAM - 2)  # windows by their start
    found = []
    low_bits = np.uint64((1 << 22) - 1)
    for at in range(0, max(n, 0), chunk):
        stop = min(at + chunk, n)
        part = grams[at : stop + WINDOW - 1]
        # The place stands in the low bits, so that the least value tells where it is.
        least = sliding_least((part & ~low_bits) | np.arange(len(part), dtype=np.uint64), WINDOW)
        inside = owner[at:stop] == owner[at + WINDOW + GRAM - 2 : stop + WINDOW + GRAM - 2]
        found.append(np.unique(least[inside] & low_bits).astype(np.int64) + at)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)


class Suffixes:
    """The kept suffixes of a batch of texts."""

    def __init__(self, texts: pa.ChunkedArray):
        words = split_words(texts)
        self.words = word_hashes(words)
        owner = words.owner()
        grams = gram_hashes(self.words, GRAM)
        self.at = kept_positions(grams, owner)
        self.keys = grams[self.at]
        self.text = owner[self.at]
        self.start = words.first[self.text]
        end = words.first[self.text + 1]
        self.left = np.minimum(self.at - self.start, LEFT)
        self.right = np.minimum(end - self.at, RIGHT)

    def classes(self) -> np.ndarray:
        """Hash of the words from left to right around each suffix."""
        n = len(self.words)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.words * powers(BASE, n), out=total[1:])
        a, b = self.at - self.left, self.at + self.right
        inner = (total[b] - total[a]) * powers(BASE_INVERSE, n + 1)[a]
        return mix(mix(inner) + (self.left << 8).astype(np.uint64) + self.right.astype(np.uint64) + self.keys)

    def codes(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """32-bit word hashes before (nearest first) and after the gram of the chosen suffixes; no word is 0."""
        short = np.maximum(self.words >> np.uint64(32), np.uint64(1)).astype(">u4")
        out = []
        for length, step, origin in ((self.left[which], -1, self.at[which] - 1), (self.right[which] - GRAM, 1, self.at[which] + GRAM)):
            width = LEFT if step < 0 else RIGHT - GRAM
            offset = np.arange(width)
            where = np.clip(origin[:, None] + step * offset, 0, max(len(short) - 1, 0))
            out.append(np.where(offset < length[:, None], short[where] if len(short) else 0, 0).astype(">u4"))
        return out[0], out[1]


def long_array(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def suffix_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, row, key, class, place): place is position * 2**16 + left * 2**8 + right."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, "text", BATCH_BYTES):
            s = Suffixes(batch["text"])
            text = pa.array(s.text)
            place = ((s.at - s.start) << 16) | (s.left << 8) | s.right
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].combine_chunks().take(text), batch["row"].combine_chunks().take(text), long_array(s.keys), long_array(s.classes()), pa.array(place)], names=["doc_id", "row", "key", "class", "place"]
            )

    return docs.mapInArrow(run, f"doc_id {kind}, row long, key long, class long, place long")


def contents(docs: DataFrame) -> DataFrame:
    """(key, class, left, right, before, after) of the suffixes that docs (row, text, wanted) asks for by position."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, "text", BATCH_BYTES):
            s = Suffixes(batch["text"])
            wanted = batch["wanted"].combine_chunks()
            owner = np.repeat(np.arange(len(wanted)), np.diff(wanted.offsets.to_numpy()))
            asked = (owner << 40) | (wanted.flatten().to_numpy(zero_copy_only=False) >> 16)
            which = np.flatnonzero(np.isin((s.text << 40) | (s.at - s.start), asked))
            before, after = s.codes(which)
            columns = [long_array(s.keys[which]), long_array(s.classes()[which]), pa.array(s.left[which].astype(np.int32)), pa.array(s.right[which].astype(np.int32))]
            columns += [pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * x.shape[1]), len(which), [None, pa.py_buffer(np.ascontiguousarray(x).tobytes())]).cast(pa.binary()) for x in (before, after)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "class", "left", "right", "before", "after"])

    return docs.mapInArrow(run, "key long, class long, left int, right int, before binary, after binary")


def starts_from(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Masks with the bits from low to high, none if low is greater."""
    one = np.int64(1)
    return np.where(low <= high, (one << (high + 1)) - (one << np.minimum(low, high + 1)), 0)


class Rows:
    """Suffixes in sorted order."""

    def __init__(self, table: pa.Table):
        column = lambda c: table[c].combine_chunks()
        self.key, self.klass = (column(c).to_numpy() for c in ("key", "class"))
        self.left, self.right = (column(c).to_numpy().astype(np.int64) for c in ("left", "right"))
        self.before, self.after = (np.frombuffer(b"".join(column(c).to_pylist()), ">u4").reshape(len(table), -1) for c in ("before", "after"))

    def matches(self) -> pa.Table:
        """(class, l, r, mask) of each suffix that has a neighbour of its gram: the most words that it shares with one
        to the left and to the right, and the starts of the stretches of LEAST words that it shares with one."""
        a, b = slice(0, max(len(self.key) - 1, 0)), slice(1, None)
        l = np.minimum(shared(self.before[a], self.before[b]), np.minimum(self.left[a], self.left[b]))  # noqa: E741
        r = np.minimum(GRAM + shared(self.after[a], self.after[b]), np.minimum(self.right[a], self.right[b]))
        same = self.key[a] == self.key[b]
        pair = np.stack((np.where(same, l, 0), np.where(same, r, 0), np.where(same, starts_from(LEAST - r, l), 0)))
        none = np.zeros((3, 1), dtype=np.int64)
        up, down = np.concatenate((pair, none), axis=1), np.concatenate((none, pair), axis=1)
        best, mask = np.maximum(up[:2], down[:2]), up[2] | down[2]
        hit = np.flatnonzero(best[1])
        columns = [self.klass[hit], best[0, hit].astype(np.int32), best[1, hit].astype(np.int32), mask[hit]]
        return pa.table(dict(zip(("class", "l", "r", "mask"), map(pa.array, columns), strict=True)))


def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each pair of rows."""
    apart = a != b
    return np.where(apart.any(axis=1), apart.argmax(axis=1), a.shape[1])


MATCH = "class long, l int, r int, mask long"
EDGE = f"{MATCH}, part int, last boolean, key long, left int, right int, before binary, after binary"
OWN = ("key", "left", "right", "before", "after")


def compare_sorted(rows: DataFrame, by: str, then: str, scratch: Scratch) -> DataFrame:
    """Sorts suffixes by key and the words in columns by and then, and gives the matches() of neighbours."""
    blank = pa.schema([("part", pa.int32()), ("last", pa.bool_()), ("key", pa.int64()), ("left", pa.int32()), ("right", pa.int32()), ("before", pa.binary()), ("after", pa.binary())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None

        def edge(row: pa.Table, last: bool) -> pa.Table:
            none = {c: pa.nulls(1, t) for c, t in (("l", pa.int32()), ("r", pa.int32()), ("mask", pa.int64()))}
            return pa.table({"class": row["class"], **none, "part": pa.array([part], pa.int32()), "last": pa.array([last]), **{c: row[c] for c in OWN}})

        for batch in stream:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held is None:
                yield from edge(table.slice(0, 1), False).to_batches()
            table = pa.concat_tables([held, table]) if held is not None else table
            found = Rows(table).matches()
            yield from pa.table({**{c: found[c] for c in found.column_names}, **{f.name: pa.nulls(found.num_rows, f.type) for f in blank}}).to_batches()
            held = table.slice(table.num_rows - 1)
        if held is not None:
            yield from edge(held, True).to_batches()

    def compare_edges(group: pa.Table) -> pa.Table:
        return Rows(group.sort_by([("last", "descending")])).matches()

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "key", by, then).sortWithinPartitions("key", by, then)
    found = scratch.keep(ordered.mapInArrow(run, EDGE), f"by-{by}")
    # The last row of each range that has rows is put beside the first of the next such range.
    edges = found.filter("part is not null")
    parts = sorted(r["part"] for r in edges.filter("last").select("part").collect())
    place = rows.sparkSession.createDataFrame(list(zip(parts, range(len(parts)), strict=True)), "part int, place int")
    limit = F.col("place") - F.when(F.col("last"), 0).otherwise(1)
    across = edges.join(F.broadcast(place), "part").select(limit.alias("limit"), "last", "class", *OWN).groupBy("limit").applyInArrow(compare_edges, MATCH)
    return found.filter("part is null").select("class", "l", "r", "mask").unionByName(across)


def stretches_by_hash(content: DataFrame, sought: DataFrame) -> DataFrame:
    """(class, mask) of stretches that classes share: those of content whose starts sought (key, starts) asks for.

    content has mask, the starts at which a suffix may share a stretch with any other.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = LEAST - GRAM
        for batch in stream:
            key, klass, asked = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "class", "asked"))
            before, after = (np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u4").reshape(batch.num_rows, -1) for c in ("before", "after"))
            for start in range(LEFT + 1):
                at = np.flatnonzero(asked >> start & 1)
                if len(at):
                    words = np.concatenate((before[at, :start], after[at, : width - start]), axis=1).astype(np.uint64)
                    hashes = mix(mix((words * powers(BASE, width)).sum(axis=1, dtype=np.uint64)) + mix(key[at].view(np.uint64) + np.uint64(start)))
                    yield pa.RecordBatch.from_arrays([long_array(hashes), pa.array(klass[at]), pa.array(np.full(len(at), start, np.int32))], names=["hash", "class", "start"])

    asked = content.join(sought, "key").withColumn("asked", F.col("mask").bitwiseAND(F.col("starts"))).filter("asked <> 0")
    rows = asked.select("key", "class", "asked", "before", "after").mapInArrow(run, "hash long, class long, start int")
    held = rows.groupBy("hash").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high").select("hash")
    return rows.join(held, "hash").groupBy("class").agg(F.bit_or(F.expr("shiftleft(1L, start)")).alias("mask"))


def small(df: DataFrame, n: int) -> DataFrame:
    """df, to be broadcast if its n rows may be."""
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, row, start_word, end_word, n_words) of each maximal stretch of repeated passages; row tells texts of one doc_id apart."""
    scratch = Scratch(docs.sparkSession, "suffixes")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", F.xxhash64("doc_id", text).alias("row"), text.alias("text"))
    suffixes = scratch.keep(suffix_rows(texts), "suffixes")
    repeated = suffixes.groupBy("key").agg(F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high")).filter("n > 1")
    keys = scratch.keep(repeated, "keys")
    single = keys.filter("low = high").select(F.col("low").alias("class"))
    mixed = keys.filter("low <> high").select("key")
    members = suffixes.join(small(mixed, mixed.count()), "key")
    classes = scratch.keep(members.groupBy("key", "class").agg(F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("one")), "classes")
    whole = single.unionByName(classes.filter("n > 1").select("class")).select("class", F.lit(ALL_STARTS).alias("mask"))
    wanted = classes.groupBy("one.row").agg(F.collect_list("one.place").alias("wanted"))
    sought = texts.select("row", "text").join(small(wanted, classes.count()), "row").select("text", "wanted")
    content = scratch.keep(contents(sought).dropDuplicates(["key", "class"]), "contents")
    found = compare_sorted(content, "after", "before", scratch).unionByName(compare_sorted(content, "before", "after", scratch))
    reach = scratch.keep(found.groupBy("class").agg(F.max("l").alias("l"), F.max("r").alias("r"), F.bit_or("mask").alias("shared")), "reach")
    # Starts from LEAST - r to l: where a stretch may be shared with any suffix at all.
    may = F.when(F.col("l") + F.col("r") >= LEAST, F.expr(f"shiftleft(1L, l + 1) - shiftleft(1L, {LEAST} - r)")).otherwise(F.lit(0).cast("long"))
    open_ = content.join(reach.select("class", may.alias("mask"), "shared"), "class").filter("mask <> 0")
    open_ = scratch.keep(open_.join(classes.select("class", (F.col("n") > 1).alias("whole")), "class"), "open")
    asking = open_.filter("not whole").select("key", F.col("mask").bitwiseAND(F.bitwise_not("shared")).alias("starts")).filter("starts <> 0")
    asking = scratch.keep(asking.groupBy("key").agg(F.bit_or("starts").alias("starts")), "asking")
    further = scratch.keep(stretches_by_hash(open_, small(asking, asking.count())), "further")
    masks = whole.unionByName(reach.filter("shared <> 0").select("class", F.col("shared").alias("mask"))).unionByName(further)
    masks = masks.groupBy("class").agg(F.bit_or("mask").alias("mask"))
    scratch.drop("contents", "by-after", "by-before", "open", "asking")
    runs = scratch.keep(masks.select("class", F.explode(runs_of("mask")).alias("run")).select("class", "run.*"), "runs")
    hits = suffixes.join(small(runs, runs.count()), "class")
    at, left, right = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255), F.col("place").bitwiseAND(255)
    stretch = hits.select("doc_id", "row", (at - F.least("high", left)).alias("start"), (at + F.least(LEAST - F.col("low"), right)).alias("end")).filter(F.col("end") - F.col("start") >= LEAST)
    return merged(stretch)


def runs_of(mask: str) -> Column:
    """array<struct<low, high>> of the runs of set bits of a mask."""
    bit = f"(shiftright({mask}, i) & 1) = 1"
    ends = lambda step: F.expr(f"filter(sequence(0, {LEFT}), i -> {bit} AND NOT {bit.replace(', i)', f', i + {step})')})")
    starts = F.expr(f"filter(sequence(0, {LEFT}), i -> {bit} AND (i = 0 OR NOT {bit.replace(', i)', ', i - 1)')}))")
    return F.arrays_zip(starts.alias("low"), ends(1).alias("high"))


def merged(stretches: DataFrame) -> DataFrame:
    """Overlapping or touching stretches of a text as one."""
    order = Window.partitionBy("doc_id", "row").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") <= reached, 0).otherwise(1)
    numbered = stretches.withColumn("fresh", fresh).withColumn("span", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy("doc_id", "row", "span").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word"))
    return spans.select("doc_id", "row", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"))
