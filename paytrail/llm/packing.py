"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted.  A document longer than the greatest is cut
into pieces of that length and a rest.  Pieces are dealt evenly over shards, and each
shard packs its pieces, longest first, into the open bin that they leave least room
in.  If none has room, a bin is opened whose size has the least cost for each token it
is expected to hold.  Expectations come from the sizes of the pieces that are left in the shard:
how full they can make the room behind the first piece (sums of sizes, by dynamic programming
over their histogram), and which share of it they are enough for beside the bins that are open.  So
permitted sizes are weighed against each other for the demand there is.  In the end every
bin is downsized to the least permitted length that holds its contents.

A shard has a bounded number of pieces, so its histogram is known and all of its bins can be open
until its end (full ones are closed at once): each piece goes where it fits best among all.

Defined results: null and empty texts have no tokens but the separator, so they are
one piece of one token.  Every token of every row is in exactly one bin.  Repeated
rows are packed as often as they occur.  Columns beyond doc_id and text are not read, but for
those that size refers to.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

LENGTHS = (512, 1024, 2048, 4096)
#: Cost of a bin of n positions: n, and what each bin costs besides, in positions.
BIN_OVERHEAD = 32
SEPARATOR = 1
PIECES_A_SHARD = 100_000
#: What is left is looked at anew when one in so many of the pieces that were left then have gone.
RENEWALS = 64


def n_tokens(text: Column) -> Column:
    """Words of a text, and one separator."""
    return F.size(F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")) + SEPARATOR


class Packer:
    """Best fit with several capacities, for pieces of these sizes that come longest first; of bins with the same room, the first opened is taken."""

    def __init__(self, lengths: tuple[int, ...], first_bin: int, sizes: np.ndarray):
        self.lengths = sorted(lengths)
        self.rooms: list[int] = []  # the different amounts of room that open bins have, sorted
        self.with_room: dict[int, list[int]] = {}  # heaps of bins
        self.held: dict[int, list] = {}  # bin: capacity, used
        self.next = first_bin
        self.left = np.bincount(sizes, minlength=self.lengths[-1] + 1)
        self.n_left = len(sizes)
        self.open_room = 0
        self.renew_at = self.n_left

    def _renew(self) -> None:
        """Looks at what is left: most[r], the fullest that it can make a room of r; demand[r], its tokens in pieces of r or less."""
        greatest = self.lengths[-1]
        sums, mask = 1, (1 << greatest + 1) - 1  # bit i: some of the pieces come to i tokens
        for size in np.flatnonzero(self.left).tolist():
            n, step = min(int(self.left[size]), greatest // size), 1
            while n > 0:
                step = min(step, n)
                sums |= sums << step * size & mask
                n, step = n - step, step * 2
        bits = np.unpackbits(np.frombuffer(sums.to_bytes(greatest // 8 + 1, "little"), np.uint8), bitorder="little")[: greatest + 1]
        place = np.arange(greatest + 1)
        self.most = np.maximum.accumulate(np.where(bits, place, 0))
        self.demand = np.cumsum(place * self.left)
        self.renew_at = self.n_left - max(1, self.n_left // RENEWALS)

    def expected(self, capacity: int, size: int) -> float:
        """Tokens that a bin begun with a piece of that size comes to hold."""
        room = capacity - size
        if not room:
            return size
        return size + min(1.0, int(self.demand[room]) / (self.open_room + room)) * int(self.most[room])

    def cost(self, capacity: int, size: int) -> float:
        expected = self.expected(capacity, size)
        return (self.fit(int(np.ceil(expected))) + BIN_OVERHEAD) / expected

    def fit(self, used: int) -> int:
        """The least permitted length for so many tokens."""
        return self.lengths[bisect_left(self.lengths, used)]

    def add(self, size: int) -> tuple[int, int, bool]:
        """Puts a piece into a bin: (bin, offset in it, whether that is full now)."""
        self.left[size] -= 1
        self.n_left -= 1
        at = bisect_left(self.rooms, size)
        if at < len(self.rooms):
            room = self.rooms[at]
            number = heappop(self.with_room[room])
            if not self.with_room[room]:
                del self.with_room[room], self.rooms[at]
            self.open_room -= room
        else:
            if self.n_left <= self.renew_at:
                self._renew()
            room = min((n for n in self.lengths if n >= size), key=lambda n: (self.cost(n, size), n))
            number, self.next = self.next, self.next + 1
            self.held[number] = [room, 0]
        held = self.held[number]
        offset, held[1] = held[1], held[1] + size
        left = room - size
        if left:
            if left not in self.with_room:
                self.with_room[left] = []
                insort(self.rooms, left)
            heappush(self.with_room[left], number)
            self.open_room += left
        return number, offset, not left

    def close(self, number: int) -> tuple[int, int]:
        """(length after downsizing, tokens) of a bin that takes no more."""
        _, used = self.held.pop(number)
        return self.fit(used), used


PIECES = "doc_id {kind}, piece int, start_token long, n_tokens int"


def cut_pieces(docs: DataFrame, size: Column, greatest: int) -> DataFrame:
    """(doc_id, piece, start_token, n_tokens) of documents of so many tokens."""
    sized = docs.select("doc_id", size.cast("long").alias("_size"))
    number = F.explode(F.sequence(F.lit(0), ((F.col("_size") - 1) / greatest).cast("int")))
    cut = sized.select("doc_id", "_size", number.alias("piece"))
    start = F.col("piece").cast("long") * greatest
    return cut.select("doc_id", "piece", start.alias("start_token"), F.least(F.lit(greatest).cast("long"), F.col("_size") - start).cast("int").alias("n_tokens"))


def pack(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, size: Column | None = None) -> DataFrame:
    """One row for each piece: doc_id, piece, start_token, n_tokens, bin_id, bin_offset, bin_length, bin_tokens.

    docs has doc_id and text; size gives a document's tokens, at least 1 (words and a
    separator if not given).
    """
    lengths = tuple(sorted(set(lengths)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    sizes = docs.select("doc_id", (n_tokens(F.col("text")) if size is None else size).alias("_n"))
    # Written, as they are counted and dealt; only identifiers and sizes move.
    pieces = Scratch(docs.sparkSession, "packing").keep(cut_pieces(sizes, F.col("_n"), lengths[-1]), "pieces")
    # Dealing them in turn keeps shards even whatever repeats.
    n_shards = -(-pieces.count() // PIECES_A_SHARD)
    shards = pieces.repartition(max(n_shards, 2)).sortWithinPartitions(F.desc("n_tokens"), "doc_id", "piece")
    schema = f"{PIECES.format(kind=kind)}, bin_id long, bin_offset int, bin_length int, bin_tokens int"

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []  # of the whole shard, which has about PIECES_A_SHARD
        types = []
        for batch in stream:
            types = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            rows += zip(*(batch.column(c).to_pylist() for c in ("doc_id", "piece", "start_token", "n_tokens")), strict=True)
        packer = Packer(lengths, TaskContext.get().partitionId() << 32, np.array([r[3] for r in rows], np.int64))
        open_rows: dict[int, list[tuple]] = {}
        names = ["doc_id", "piece", "start_token", "n_tokens", "bin_id", "bin_offset", "bin_length", "bin_tokens"]

        def closed(numbers: list[int]) -> Iterator[pa.RecordBatch]:
            out = []
            for number in numbers:
                length, used = packer.close(number)
                out += [(*r, number, offset, length, used) for r, offset in open_rows.pop(number)]
            for at in range(0, len(out), 8192):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out[at : at + 8192], strict=True), types, strict=True)], names=names)

        full = []
        for row in rows:
            number, offset, done = packer.add(row[3])
            open_rows.setdefault(number, []).append((row, offset))
            if done:
                full.append(number)
            if len(full) == 4096:
                yield from closed(full)
                full = []
        yield from closed(full)
        yield from closed(sorted(open_rows))

    return shards.mapInArrow(run, schema)
