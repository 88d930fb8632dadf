"""Benchmark decontamination by template windows.

Texts are canonicalised into templates: words lose the punctuation around them and
their case, numbers, units and names become typed placeholders, and words of
punctuation alone go.  Windows of WINDOW template tokens (or the whole of a shorter item)
are hashed and joined between documents and benchmark items.  Windows of one item that
match at one alignment of a text are taken together: what stands in the text for a slot
value of the item must be the same wherever that value occurs, and different values
must stand for different ones, unless at least half of the values are unchanged.  Numbers and names that a question was re-parameterised
with do not hide it; a chance likeness of shape is told by its inconsistent slots.

Numbers are words with a digit and number words (English ones, from zero to ninety-nine, and the
great ones).  Three templates are tried: with names as they are; with names as placeholders, but for a
sentence's first word, which is no name there but may look like one; and, for items of one window, with
every word that has a capital as a name, since such an item has no window that its first
word isn't in.

A text is contaminated by an item if the tokens of the item that its consistent
windows cover are at least COVERED, or SHARE of a shorter item.

Items of fewer than SHORTEST template tokens, and items with a window of fewer than
LITERALS plain words, are also looked for as they are: their literal tokens are all
words, numbers and units unchanged and words of punctuation (operators) included,
and windows of them match exactly.  An item of fewer than LITERALS literal tokens
must fill a line of the text, which tells it from a common phrase.

Defined results: null and empty texts match nothing.  A benchmark of repeated items
gives a row for each.  Rows of documents that repeat an identifier are told apart by
their texts; rows that repeat both give one row.  Columns beyond doc_id (item_id) and text are not
read; clean_documents() gives all columns of docs, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, without
from .textkernels import BASE, batches, layout, mix, span_hashes, split_words
from .toxicity import trim

WINDOW = 8
COVERED, SHARE = 12, 0.8
SHORTEST = 5
#: Tokens of a window that must be words of their own.
LITERALS = 4
BATCH_BYTES = 1 << 20
#: Distinct benchmark windows that tasks may hold, 8 bytes each.
HELD_WINDOWS = 4_000_000
#: Placeholders.
NUMBER, UNIT, NAME = (np.uint64(x) for x in (1, 2, 3))
#: What tells the hashes of literal windows from those of templates.
LITERAL = np.uint64(0x11EA7C0DE5)
UNITS = (
    "mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t gram grams kilogram kilograms ton tons tonne tonnes oz lb lbs pound pounds "
    "ml cl dl l liter liters litre litres gallon gallons ms s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years "
    "mph kph kmh km/h m/s hz khz mhz ghz w kw mw v kb mb gb tb bytes percent degrees celsius fahrenheit usd eur gbp dollar dollars euro euros cent cents"
).split()


_ONES = "one two three four five six seven eight nine".split()
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
_TEENS = "zero ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
NUMBER_WORDS = [*_ONES, *_TEENS, *_TENS, *(f"{t}-{o}" for t in _TENS for o in _ONES), "hundred", "thousand", "million", "billion", "dozen"]


def _hashes_of(terms: list[str]) -> np.ndarray:
    data, limits = layout(pa.array(terms))
    return np.unique(span_hashes(data, limits[:-1], limits[1:]))


UNIT_HASHES = _hashes_of(UNITS)
LONGEST_UNIT = max(map(len, UNITS))
NUMBER_HASHES = _hashes_of(NUMBER_WORDS)
LONGEST_NUMBER = max(map(len, NUMBER_WORDS))


def lower_latin(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes, A-Z lower already, with the capitals from U+00C0 to U+00DE lower-cased too."""
    at = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = at[(data[at] >= 0x80) & (data[at] <= 0x9E) & (data[at] != 0x97)]
    out = data.copy()
    out[capital] += 0x20
    return out


class Templates:
    """Template tokens of a batch: codes with and without name placeholders, slots and limits of the texts."""

    def __init__(self, texts: pa.ChunkedArray):
        words = split_words(texts)
        starts, ends = trim(words.lowered, words.starts, words.ends)
        kept = np.flatnonzero(ends > starts)
        self.data = words.data
        words.lowered = lower_latin(words.lowered)
        self.starts, self.ends = starts[kept], ends[kept]
        self.first = np.searchsorted(kept, words.first)
        hashes = span_hashes(words.lowered, self.starts, self.ends) | np.uint64(4)  # never a placeholder
        digits = np.concatenate(([0], np.cumsum((self.data >= 48) & (self.data <= 57))))
        number = digits[self.ends] > digits[self.starts]
        short = np.flatnonzero(self.ends - self.starts <= LONGEST_NUMBER)
        number[short] |= np.isin(hashes[short], NUMBER_HASHES | np.uint64(4))
        short = np.flatnonzero(self.ends - self.starts <= LONGEST_UNIT)
        unit = np.zeros(len(kept), dtype=bool)
        unit[short] = np.isin(hashes[short], UNIT_HASHES | np.uint64(4))
        self.plain = np.where(number, NUMBER, np.where(unit, UNIT, hashes))
        capital, begins = self._names(words, kept)
        self.named = np.where(capital & ~begins & ~number, NAME, self.plain)
        self.headed = np.where(capital & ~number, NAME, self.plain)
        self.owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        bare = ends <= starts
        self.literal = span_hashes(words.lowered, np.where(bare, words.starts, starts), np.where(bare, words.ends, ends))
        self.literal_first, self.literal_owner = words.first, words.owner()
        line = np.concatenate(([0], np.cumsum(self.data == 10)))[words.starts]
        self.fresh = np.ones(len(line) + 1, dtype=bool)  # a line or text begins there
        self.fresh[1:-1] = line[1:] > line[:-1]
        self.fresh[words.first] = True

    def _names(self, words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words with a capital, then a small letter; words that begin a sentence."""
        if not len(kept):
            return np.zeros(0, dtype=bool), np.zeros(0, dtype=bool)
        head = self.data[self.starts]
        after = self.data[np.minimum(self.starts + 1, len(self.data) - 1)]
        capital = (head >= 65) & (head <= 90) | (head == 0xC3) & (after >= 0x80) & (after <= 0x9E)
        second = np.where(head == 0xC3, self.data[np.minimum(self.starts + 2, len(self.data) - 1)], after)
        small = (second >= 97) | (self.ends - self.starts == 1)
        lines = np.concatenate(([0], np.cumsum(words.data == 10)))
        before = kept - 1
        stop = np.isin(words.data[words.ends[before] - 1], np.frombuffer(b".!?:;", np.uint8)) | (lines[words.starts[kept]] > lines[words.ends[before] - 1])
        begins = np.isin(kept, words.first[:-1]) | stop
        return capital & small, begins

    def windows(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, hashes) of the windows of one text each: plain ones, those that hold names, those that begin with one or hold one after a stop."""
        n = len(self.plain) - size + 1
        if n <= 0:
            return
        before = None
        for codes in (self.plain, self.named, self.headed):
            literal = np.concatenate(([0], np.cumsum(codes > NAME)))
            inside = (self.owner[:n] == self.owner[size - 1 :]) & (literal[size:] - literal[:-size] >= min(LITERALS, size))
            if before is not None:  # only those that are others than before
                other = np.concatenate(([0], np.cumsum(codes != before)))
                inside &= other[size:] > other[:-size]
            yield self._hashed(codes, size, inside)
            before = codes

    def weak(self) -> np.ndarray:
        """Texts that are too short for template windows, or have one with too few plain words."""
        n = np.diff(self.first)
        out = n < SHORTEST
        plain = np.concatenate(([0], np.cumsum(self.plain > NAME)))
        for size in {min(WINDOW, int(x)) for x in n[~out]}:
            at = np.arange(max(len(self.plain) - size + 1, 0))
            at = at[self.owner[at] == self.owner[at + size - 1]]
            at = at[np.minimum(n, WINDOW)[self.owner[at]] == size]
            out[self.owner[at[plain[at + size] - plain[at] < min(LITERALS, size)]]] = True
        return out

    def literal_windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the windows of literal tokens of one text each."""
        at = np.arange(max(len(self.literal) - size + 1, 0))
        inside = self.literal_owner[at] == self.literal_owner[at + size - 1]
        if size < LITERALS:
            inside &= self.fresh[at] & self.fresh[at + size] & (np.cumsum(self.fresh)[at + size] - np.cumsum(self.fresh)[at] == 1)
        at, hashes = self._hashed(self.literal, size, inside)
        return at, mix(hashes ^ LITERAL)

    @staticmethod
    def _hashed(codes: np.ndarray, size: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(wanted)
        out = np.full(len(at), np.uint64(size), dtype=np.uint64)
        for k in range(size):
            out = out * np.uint64(BASE) + codes[at + k]
        return at, mix(out)

    def slots(self, at: int, size: int, kind: int) -> list[str]:
        """What stands at the placeholders of a window of that template."""
        codes = (self.plain, self.named, self.headed)[kind]
        return [bytes(self.data[self.starts[i] : self.ends[i]]).decode().lower() for i in range(at, at + size) if codes[i] <= NAME]


WINDOW_ROW = "hash long, size int, pos int, slots array<string>, literal boolean"
WINDOW_TYPE = [("hash", pa.int64()), ("size", pa.int32()), ("pos", pa.int32()), ("slots", pa.list_(pa.string())), ("literal", pa.bool_())]


def _literal_rows(t: Templates, sizes: list[int], keep) -> list[tuple]:
    """_rows() of literal windows, which have no slots."""
    out = []
    for size in sizes:
        at, hashes = t.literal_windows(size)
        hit = keep(hashes)
        for i, h in zip(at[hit].tolist(), hashes[hit].view(np.int64).tolist(), strict=True):
            text = int(t.literal_owner[i])
            out.append((text, h, size, i - int(t.literal_first[text]), [], True))
    return out


def _rows(t: Templates, sizes: list[int], keep, of_items: bool = False) -> list[tuple]:
    """(text, hash, size, pos, slots, literal) of the windows whose hashes pass keep; of items, the third template only if they are one window."""
    out = []
    n = np.diff(t.first)
    for size in sizes:
        for kind, (at, hashes) in enumerate(t.windows(size)):
            hit = keep(hashes)
            if of_items and kind == 2:
                hit = hit & (n[t.owner[at]] == size)
            for i, h in zip(at[hit].tolist(), hashes[hit].view(np.int64).tolist(), strict=True):
                text = int(t.owner[i])
                out.append((text, h, size, i - int(t.first[text]), t.slots(i, size, kind), False))
    return out


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, n_tokens, whole, hash, size, pos, slots, literal) of the items' template windows, and the literal ones of weak items.

    n_tokens counts an item's template tokens, whole those of the window's kind.
    """
    kind = benchmark.schema["item_id"].dataType.simpleString()

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, "text", BATCH_BYTES):
            t = Templates(batch["text"])
            n = np.diff(t.first)
            rows = []
            for size in sorted({min(WINDOW, int(x)) for x in n if x >= SHORTEST}):
                rows += [r for r in _rows(t, [size], lambda h: np.ones(len(h), dtype=bool), of_items=True) if min(WINDOW, n[r[0]]) == size]
            literal, weak = np.diff(t.literal_first), t.weak()
            for size in sorted({min(WINDOW, int(x)) for x in literal[weak] if x}):
                rows += [r for r in _literal_rows(t, [size], lambda h: np.ones(len(h), dtype=bool)) if weak[r[0]] and min(WINDOW, literal[r[0]]) == size]
            if rows:
                text, *columns = zip(*rows, strict=True)
                ids = batch["item_id"].combine_chunks().take(pa.array(text))
                whole = np.where(columns[-1], literal[list(text)], n[list(text)])
                counts = [pa.array(x.astype(np.int32)) for x in (n[list(text)], whole)]
                yield pa.RecordBatch.from_arrays([ids, *counts, *(pa.array(x, k) for x, (_, k) in zip(columns, WINDOW_TYPE, strict=True))], names=["item_id", "n_tokens", "whole", *(c for c, _ in WINDOW_TYPE)])

    return benchmark.mapInArrow(run, f"item_id {kind}, n_tokens int, whole int, {WINDOW_ROW}")


def document_windows(docs: DataFrame, sizes: list[int], literal_sizes: list[int], held: np.ndarray | None) -> DataFrame:
    """(doc_id, row, hash, size, pos, slots, literal) of docs' windows: those in held (sorted hashes), or all if it is None."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    marks = np.zeros(1 << 22, dtype=bool)
    if held is not None:
        marks[held >> np.uint64(42)] = True

    def keep(hashes: np.ndarray) -> np.ndarray:
        if held is None:
            return np.ones(len(hashes), dtype=bool)
        out = marks[hashes >> np.uint64(42)]
        at = np.flatnonzero(out)
        if len(at):
            out[at] = held[np.minimum(np.searchsorted(held, hashes[at]), len(held) - 1)] == hashes[at]
        return out

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, "text", BATCH_BYTES):
            t = Templates(batch["text"])
            rows = _rows(t, sizes, keep) + _literal_rows(t, literal_sizes, keep)
            if rows:
                text, *columns = zip(*rows, strict=True)
                ids, row = (batch[c].combine_chunks().take(pa.array(text)) for c in ("doc_id", "row"))
                yield pa.RecordBatch.from_arrays([ids, row, *(pa.array(x, k) for x, (_, k) in zip(columns, WINDOW_TYPE, strict=True))], names=["doc_id", "row", *(c for c, _ in WINDOW_TYPE)])

    return docs.mapInArrow(run, f"doc_id {kind}, row long, {WINDOW_ROW}")


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def contaminated(docs: DataFrame, benchmark: DataFrame, held_windows: int = HELD_WINDOWS) -> DataFrame:
    """(doc_id, row, item_id, item_tokens, covered_tokens, n_windows, new_values) of each document and item that it holds.

    docs has doc_id and text; row is text_key() of the text.  Benchmarks of more than
    held_windows windows are joined with all windows of the documents instead.
    """
    scratch = Scratch(docs.sparkSession, "decontamination")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    items = scratch.keep(benchmark_windows(benchmark.select("item_id", text.alias("text"))), "items")
    hashes = items.select("hash").distinct()
    every = items.select("size", "literal").distinct().collect()
    sizes, literal_sizes = (sorted(r["size"] for r in every if r["literal"] == x) for x in (False, True))
    held = None
    if hashes.count() <= held_windows:
        held = np.sort(np.array([r["hash"] for r in hashes.toLocalIterator()], dtype=np.int64).view(np.uint64))
    rows = docs.select("doc_id", text_key(F.col("text")).alias("row"), text.alias("text"))
    found = scratch.keep(document_windows(rows, sizes, literal_sizes, held), "found")
    other = items.select("hash", "item_id", "n_tokens", "whole", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    pairs = found.join(other, "hash").withColumn("shift", F.col("pos") - F.col("item_pos"))
    covered = F.expr("sequence(item_pos, item_pos + size - 1)")
    value = F.expr("transform(arrays_zip(slots, item_slots), x -> struct(x.item_slots AS old, x.slots AS new))")
    # All that one alignment of an item gathers is bounded by the item's length.
    aligned = pairs.groupBy("doc_id", "row", "item_id", "n_tokens", "whole", "literal", "shift").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set(covered)))).alias("covered_tokens"),
        F.countDistinct("item_pos").alias("n_windows"),
        F.array_distinct(F.flatten(F.collect_set(value))).alias("values"),
    )
    n = F.size("values")
    changed = F.size(F.filter("values", lambda v: v["old"] != v["new"]))
    one_to_one = (F.size(F.array_distinct(F.col("values.old"))) == n) & (F.size(F.array_distinct(F.col("values.new"))) == n)
    same = one_to_one | (2 * changed <= n)
    enough = F.col("covered_tokens") >= F.least(F.lit(COVERED), F.ceil(F.col("whole") * SHARE))
    hits = aligned.filter(same & enough).withColumn("new_values", changed)
    best = F.max(F.struct("covered_tokens", "n_windows", "new_values")).alias("b")
    return hits.groupBy("doc_id", "row", "item_id", F.col("n_tokens").alias("item_tokens")).agg(best).select("doc_id", "row", "item_id", "item_tokens", "b.*")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns."""
    return without(docs, contaminated(docs.select("doc_id", "text"), benchmark).select("doc_id", F.col("row").alias("key")), text_key(F.col("text")), Scratch(docs.sparkSession, "clean"))
