"""Language-model scores from a weighted backoff automaton.

Smoothed n-grams are the states.  A state has an arc for every n-gram that extends
it and is in the model, and a failure arc to the state without its first token.
An arc weighs log10 p, a failure arc log10 of the mass that the state's arcs leave:

    p(w)        = (c(w) + 1) / (N + V + 1)
    p(w | h)    = (c(hw) - D) / c(h) + left(h) p(w | h')      if hw is in the model
                = left(h) p(w | h')                           otherwise
    left(h)     = 1 - sum over arcs of (c(hw) - D) / c(h)

where h' is h without its first token; each state's probabilities sum to one.  An
n-gram is in the model if it was seen min_count times in training, whatever the
input's size (1 takes all; every single word is a state of its own anyway).

The model is never in one place.  Documents are encoded once into blocks of
bounded size.  A block sends its distinct words, packed by range of hash, to the tasks
that sum them up over all blocks, and these answer each block's packs in their
order.  Of longer n-grams it first sends sketches, 32 bits of hash for each, and
the parts answer with a bit for those that may reach min_count; only these go
out with their whole keys and histories.  So a task holds one part of the counts, or one
block and the part of the automaton that it can reach.  Parts grow in number with
the n-grams, not in size.  Within a block, segments of documents go through the automaton from left to right
in step, each carrying its state; a segment that continues a document first runs
over the tokens before it, which fixes its state.

Defined results: null and empty texts have the end token only.  A null in the column held counts as false.  Rows that repeat
an identifier are scored alike and count as often as they occur.  A word's key is
64 bits of hash; at 10**9 distinct words the chance of any clash is about 3 %.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .textkernels import BASE, batches, mix, split_words, word_hashes

ORDER = 3
#: Training occurrences that make an n-gram of several words an arc.
MIN_COUNT = 2
BLOCK_BYTES = 12 << 20
PART_KEYS = 1_000_000
#: Blocks with their answers that one task goes through.
TASK_BLOCKS = 8
DISCOUNT = 0.75
SEGMENT = 256
#: Key of the end token.
END = np.uint64(0x5EED0FE2D)


def packed(x: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(x).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpacked(raw: bytes, dtype) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd"), dtype) if raw else np.zeros(0, dtype)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte: their leading bytes are zeros."""
    return packed(np.diff(keys, prepend=keys[:1]).view(np.uint8).reshape(-1, keys.itemsize).T) + keys[:1].tobytes()


def unpacked_keys(raw: bytes | None, dtype=np.uint64) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    if not raw or int.from_bytes(raw[:8], "little") == 0:
        return np.zeros(0, dtype)
    planes = unpacked(raw[:-size], np.uint8).reshape(size, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(dtype).ravel(), dtype=dtype) + np.frombuffer(raw[-size:], dtype)


# -- blocks ----------------------------------------------------------------------------------------


def encode(docs: DataFrame) -> DataFrame:
    """Rows of one block each: its documents, their sizes in tokens, its words and its tokens as indices into them."""
    field = docs.schema["doc_id"]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches(stream, "text", BLOCK_BYTES):
            words = split_words(batch["text"])
            sizes = np.diff(words.first) + 1
            tokens = np.insert(word_hashes(words), words.first[1:], END)
            keys, places, often = np.unique(tokens, return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")  # small indices for frequent words pack well
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            planes = rank[places].astype("<u4").view(np.uint8).reshape(-1, 4).T
            ids, held = (batch[c].combine_chunks() for c in ("doc_id", "held"))
            row = {
                "block": pa.array([block]),
                "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                "held": pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held),
                "sizes": pa.array([sizes.tolist()], pa.list_(pa.int32())),
                "n_keys": pa.array([len(keys)], pa.int64()),
                "n_train": pa.array([int(sizes[~held.to_numpy(zero_copy_only=False)].sum())], pa.int64()),
                "keys": pa.array([packed(keys[order])], pa.binary()),
                "tokens": pa.array([packed(planes)], pa.binary()),
            }
            yield pa.RecordBatch.from_arrays(list(row.values()), names=list(row))
            block += 1

    kind = field.dataType.simpleString()
    return docs.mapInArrow(run, f"block long, doc_ids array<{kind}>, held array<boolean>, sizes array<int>, n_keys long, n_train long, keys binary, tokens binary")


class Level:
    """The distinct n-grams of one length in a block.

    places: index of the n-gram that ends at each token, or -1; seen: training occurrences
    in this block; first: a token at which each ends; counts and mass: over all training texts.
    """

    def __init__(self, keys: np.ndarray, places: np.ndarray, train: np.ndarray):
        self.keys, self.places = keys, places
        at = np.flatnonzero(places >= 0)
        self.seen = np.bincount(places[at][train[at]], minlength=len(keys)).astype(np.uint32)
        self.first = np.zeros(len(keys), dtype=np.int64)
        self.first[places[at[::-1]]] = at[::-1]
        self.counts = self.mass = np.zeros(len(keys))


class Block:
    """A block with the levels that are known; words too rare for longer n-grams have no key."""

    def __init__(self, row: dict, least: int):
        self.least = least  # training occurrences that words within longer n-grams need
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.train = np.repeat(~np.array(row["held"], dtype=bool), self.sizes)
        planes = unpacked(row["tokens"], np.uint8).reshape(4, -1)
        places = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
        keys = unpacked(row["keys"], np.uint64) if "keys" in row else np.zeros(row["n_keys"], np.uint64)
        self.levels = [Level(keys, places, self.train)]

    def grams(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length from 2 to order: (tokens at which an n-gram of known words ends, its key)."""
        words = self.levels[0]
        known = words.counts[words.places] >= self.least
        place = np.arange(len(known)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        own = words.keys[words.places]
        at, keys = np.flatnonzero(known), own[known]
        for length in range(2, order + 1):
            whole = np.zeros(len(known), dtype=np.uint64)
            whole[at] = keys
            held = np.zeros(len(known) + 1, dtype=bool)
            held[at] = True
            at = np.flatnonzero(known & (place >= length - 1) & held[np.arange(len(known)) - 1])
            keys = mix(whole[at - 1] * np.uint64(BASE) + own[at])
            yield at, keys

    def grow(self, order: int, marks: dict[int, list[dict]] | None) -> None:
        """Adds the levels of longer n-grams; with marks (answers to their sketches), those only that may be in the model."""
        for level, (at, keys) in enumerate(self.grams(order), 1):
            keys, where = np.unique(keys, return_inverse=True)
            use = np.ones(len(keys), dtype=bool) if marks is None else bits_in_order(marks.get(level, []), keys)
            above = self.levels[-1].places
            # Whether both shorter n-grams may be in the model is the same wherever an n-gram occurs.
            whole = np.zeros(len(keys), dtype=bool)
            whole[where[(above[at] >= 0) & (above[at - 1] >= 0)]] = True
            use &= whole
            places = np.full(len(self.train), -1, dtype=np.int64)
            places[at] = np.where(use, np.cumsum(use) - 1, -1)[where]
            self.levels.append(Level(keys[use], places, self.train))

    def take_words(self, answers: list[dict]) -> None:
        words = self.levels[0]
        answers = sorted((a for a in answers if a["kind"] == "word"), key=lambda a: a["part"])
        words.counts = np.zeros(len(words.keys))
        for a in answers:
            at, sums = unpacked(a["place"], np.int32), unpacked(a["value"], np.int64)
            words.counts[at] = sums
            words.keys[at[sums >= self.least]] = unpacked_keys(a["keys"])

    def take(self, answers: list[dict], order: int, sketched: bool) -> None:
        """All levels, with the counts and masses that are among the answers."""
        by: dict[tuple[int, str], list[dict]] = {}
        for a in sorted(answers, key=lambda a: a["part"]):
            by.setdefault((a["level"], a["kind"]), []).append(a)
        self.take_words(answers)
        self.grow(order, {k: by.get((k, "mark"), []) for k in range(1, order)} if sketched else None)
        for k, level in enumerate(self.levels):
            if k:
                level.counts = in_order(by.get((k, "count"), []), level.keys)
            own = level.keys != 0
            level.mass = np.zeros(len(own))
            level.mass[own] = in_order(by.get((k, "mass"), []), level.keys[own])


# -- counting over all blocks ------------------------------------------------------------------


def position(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where keys lie in so many equal ranges of them: the part in the upper 32 bits, the place within it in the others.

    It grows with the key, so what is sorted by key is sorted by part and by place already.
    """
    return (keys >> np.uint64(32)) * np.uint64(parts) + ((keys & np.uint64(0xFFFFFFFF)) * np.uint64(parts) >> np.uint64(32))


def short(keys: np.ndarray, parts: int) -> np.ndarray:
    """What a sketch holds of a key: its place within its part."""
    return (position(keys, parts) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def key_order(keys: np.ndarray) -> np.ndarray:
    return np.arange(len(keys)) if (keys[1:] >= keys[:-1]).all() else np.argsort(keys)


def deal(keys: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    """(part, indices of its keys, sorted by key) for each part that has any, in order."""
    order = key_order(keys)
    part = position(keys[order], parts) >> np.uint64(32)
    cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
    return [(int(part[first]), x) for first, x in zip([0, *cuts], np.split(order, cuts), strict=True) if len(x)]


def in_order(answers: list[dict], keys: np.ndarray) -> np.ndarray:
    """The answers to keys, which were dealt to the parts that answer."""
    out = np.zeros(len(keys))
    if answers and len(keys):
        out[key_order(keys)] = np.concatenate([unpacked(a["value"], np.float64) for a in answers])
    return out


def bits_in_order(answers: list[dict], keys: np.ndarray) -> np.ndarray:
    """The marks of sorted keys whose sketches were dealt."""
    if not answers or not len(keys):
        return np.zeros(len(keys), dtype=bool)
    part = position(keys, answers[0]["parts"]) >> np.uint64(32)
    sizes = np.diff(np.flatnonzero(part[1:] != part[:-1]) + 1, prepend=0, append=len(keys))
    return np.concatenate([np.unpackbits(unpacked(a["value"], np.uint8), count=n) for a, n in zip(answers, sizes.tolist(), strict=True)]).astype(bool)


def pack_rows(block: int, level: int, kind: str, keys: np.ndarray, parts: int, seen: np.ndarray, history: np.ndarray | None = None) -> list[dict]:
    """A row for each part: sorted keys, and for words their places in the block, for longer n-grams their histories."""
    rows = []
    for part, at in deal(keys, parts):
        row = {"part": part, "block": block, "level": level, "kind": kind, "keys": packed_keys(keys[at]), "seen": packed(seen[at]), "histories": None, "place": None}
        if kind == "word":
            row["place"] = packed(at.astype(np.int32))
        if history is not None:
            own, place = np.unique(history[at], return_inverse=True)
            row |= {"histories": packed_keys(own), "place": packed(place.astype(np.int32))}
        rows.append(row)
    return rows


PACK_TYPE = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("level", pa.int32()), ("kind", pa.string()), ("keys", pa.binary()), ("seen", pa.binary()), ("histories", pa.binary()), ("place", pa.binary())])
PACK = "part int, block long, level int, kind string, keys binary, seen binary, histories binary, place binary"
ANSWER_TYPE = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("level", pa.int32()), ("kind", pa.string()), ("keys", pa.binary()), ("place", pa.binary()), ("value", pa.binary()), ("parts", pa.int32())])
ANSWER = "part int, block long, level int, kind string, keys binary, place binary, value binary, parts int"
#: Blocks of rows that answer no block: what a part's arcs take from their states, and a part's totals.
MASSES, TOTALS = -1, -2


def word_packs(blocks: DataFrame, parts: int) -> DataFrame:
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                words = Block(row, 0).levels[0]
                yield from pa.Table.from_pylist(pack_rows(row["block"], 0, "word", words.keys, parts, words.seen), PACK_TYPE).to_batches()

    return blocks.mapInArrow(run, PACK)


def by_block(blocks: DataFrame, answers: DataFrame, n_blocks: int, run, schema: str) -> DataFrame:
    """run(block, its answers) for each block; a task goes through a bounded number of them."""
    width = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_blocks // TASK_BLOCKS))
    left, right = blocks.repartition(width, "block"), answers.filter("block >= 0").repartition(width, "block")
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(run, schema)


def answer(row: dict, **values) -> dict:
    return {"part": row["part"], "block": row["block"], "level": row["level"], "kind": row["kind"], "keys": None, "place": None, "parts": None} | values


def resolve_words(packs: DataFrame, parts: int, least: int) -> DataFrame:
    """Counts of each pack's words; those that reach least come back with their keys, so that blocks can go without them."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        held = [unpacked_keys(r["keys"]) for r in rows]
        keys, where = np.unique(np.concatenate(held), return_inverse=True)
        total = np.bincount(where, weights=np.concatenate([unpacked(r["seen"], np.uint32) for r in rows]), minlength=len(keys)).astype(np.int64)
        out, at = [], 0
        for r, own in zip(rows, held, strict=True):
            sums = total[where[at : at + len(own)]]
            at += len(own)
            out.append(answer(r, keys=packed_keys(own[sums >= least]), place=r["place"], value=packed(sums), parts=parts))
        out.append(answer(rows[0], block=TOTALS, value=packed(np.array([total.sum(), (total > 0).sum()], dtype=float))))
        return pa.Table.from_pylist(out, ANSWER_TYPE)

    return packs.groupBy("part").applyInArrow(run, ANSWER)


def marked(blocks: DataFrame, told: DataFrame, n_blocks: int, order: int, parts: int, least: int) -> DataFrame:
    """Answers to sketches: a bit for each n-gram of a block that may have been seen least times."""

    def sketch(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        block = Block(row, least)
        block.take_words(right.to_pylist())
        rows = []
        for level, (at, keys) in enumerate(block.grams(order), 1):
            keys, where = np.unique(keys, return_inverse=True)
            seen = np.bincount(where[block.train[at]], minlength=len(keys)).astype(np.uint32)
            for part, i in deal(keys, parts):
                rows.append({"part": part, "block": row["block"], "level": level, "kind": "mark", "keys": packed_keys(short(keys[i], parts)), "seen": packed(seen[i]), "histories": None, "place": None})
        return pa.Table.from_pylist(rows, PACK_TYPE)

    def mark(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        held = [unpacked_keys(r["keys"], np.uint32) for r in rows]
        keys, where = np.unique(np.concatenate(held), return_inverse=True)
        total = np.bincount(where, weights=np.concatenate([unpacked(r["seen"], np.uint32) for r in rows]), minlength=len(keys))
        cuts = np.cumsum([len(x) for x in held])[:-1]
        return pa.Table.from_pylist([answer(r, value=packed(np.packbits(x)), parts=parts) for r, x in zip(rows, np.split(total[where] >= least, cuts), strict=True)], ANSWER_TYPE)

    return by_block(blocks, told, n_blocks, sketch, PACK).groupBy("level", "part").applyInArrow(mark, ANSWER)


def gram_packs(blocks: DataFrame, told: DataFrame, n_blocks: int, level: int, parts: int, least: int, sketched: bool) -> DataFrame:
    """Packs of the n-grams of one level that may be in the model, with their histories."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        block = Block(row, least)
        block.take(right.to_pylist(), level + 1, sketched)
        above, own = block.levels[-2:]
        history = above.keys[above.places[own.first - 1]]
        return pa.Table.from_pylist(pack_rows(row["block"], level, "count", own.keys, parts, own.seen, history), PACK_TYPE)

    return by_block(blocks, told, n_blocks, run, PACK)


def state_packs(blocks: DataFrame, told: DataFrame, n_blocks: int, order: int, parts: int, least: int, sketched: bool) -> DataFrame:
    """Packs of all n-grams that may be states."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        block = Block(row, least)
        block.take(right.to_pylist(), order - 1, sketched)
        rows = []
        for k, level in enumerate(block.levels):
            keys = level.keys[level.keys != 0]  # words too rare for longer n-grams have none, and are no states
            rows += pack_rows(row["block"], k, "mass", keys, parts, np.zeros(len(keys), np.uint32))
        return pa.Table.from_pylist(rows, PACK_TYPE)

    return by_block(blocks, told, n_blocks, run, PACK)


def resolve_grams(packs: DataFrame, parts: int, state_parts: int, least: int) -> DataFrame:
    """Counts of each pack's n-grams; what those seen least times take from their states is given out as packs for the states' parts."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        held = [unpacked_keys(r["keys"]) for r in rows]
        keys, where = np.unique(np.concatenate(held), return_inverse=True)
        total = np.bincount(where, weights=np.concatenate([unpacked(r["seen"], np.uint32) for r in rows]), minlength=len(keys))
        cuts = np.cumsum([len(x) for x in held])[:-1]
        out = [answer(r, value=packed(x), parts=parts) for r, x in zip(rows, np.split(total[where], cuts), strict=True)]
        history = np.zeros(len(keys), dtype=np.uint64)
        history[where] = np.concatenate([unpacked_keys(r["histories"])[unpacked(r["place"], np.int32)] for r in rows])
        arcs = total >= least
        states, of = np.unique(history[arcs], return_inverse=True)
        mass = np.bincount(of, weights=total[arcs] - DISCOUNT, minlength=len(states))
        out += [answer(rows[0], part=p, block=MASSES, level=rows[0]["level"] - 1, kind="mass", keys=packed_keys(states[at]), value=packed(mass[at])) for p, at in deal(states, state_parts)]
        return pa.Table.from_pylist(out, ANSWER_TYPE)

    return packs.groupBy("level", "part").applyInArrow(run, ANSWER)


def resolve_masses(asked: DataFrame, taken: DataFrame, parts: int) -> DataFrame:
    """What the arcs of each pack's states take in all."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        given = [r for r in rows if r["block"] == MASSES]
        states, where = np.unique(np.concatenate([np.zeros(0, np.uint64), *(unpacked_keys(r["keys"]) for r in given)]), return_inverse=True)
        mass = np.append(np.bincount(where, weights=np.concatenate([np.zeros(0), *(unpacked(r["value"], np.float64) for r in given)]), minlength=len(states)), 0.0)
        out = []
        for r in rows:
            if r["block"] >= 0:
                own = unpacked_keys(r["keys"])
                at = np.searchsorted(states, own)
                found = (at < len(states)) & (np.append(states, np.uint64(0))[at] == own)
                out.append(answer(r, value=packed(np.where(found, mass[at], 0.0)), parts=parts))
        return pa.Table.from_pylist(out, ANSWER_TYPE)

    columns = ("part", "block", "level", "kind", "keys")
    rows = asked.select(*columns, F.lit(None).cast("binary").alias("value")).unionByName(taken.select(*columns, "value"))
    return rows.groupBy("level", "part").applyInArrow(run, ANSWER)


# -- the automaton of a block --------------------------------------------------------------------


class Automaton:
    """Arcs and failure arcs of the n-grams of one block; places say which n-gram ends at each token."""

    def __init__(self, levels: list[Level], n: int, v: int, least: int):
        self.levels, self.order = levels, len(levels)
        base = np.log10((levels[0].counts + 1) / (n + v + 1))
        self.unigram, self.known = base, levels[0].counts > 0
        self.weight, self.fall, self.state = [base], [], []
        for k, level in enumerate(levels[:-1]):
            with np.errstate(divide="ignore"):
                left = 1 - level.mass / np.maximum(level.counts, 1)
                self.fall.append(np.log10(np.maximum(left, 1e-12)))
            self.state.append(level.mass > 0)
            longer = levels[k + 1]
            first = longer.first
            history = level.places[first - 1] if len(first) else first
            # p(w | h') is the weight of the n-gram of this level that ends at the same token.
            lower = 10 ** self.weight[k][level.places[first]] if len(first) else np.zeros(0)
            total = np.maximum(level.counts[history], 1)
            p = np.maximum(longer.counts - DISCOUNT, 0) / total + np.maximum(1 - level.mass[history] / total, 1e-12) * lower
            self.weight.append(np.where(longer.counts >= least, np.log10(np.maximum(p, 1e-300)), -np.inf))

    def run(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each document: its score, its score by single words and its known tokens."""
        places = [x.places for x in self.levels]
        ends = np.cumsum(sizes)
        single = np.add.reduceat(self.unigram[places[0]], ends - sizes)
        known = np.add.reduceat(self.known[places[0]].astype(np.int64), ends - sizes)
        cuts = -(-sizes // SEGMENT)
        doc = np.repeat(np.arange(len(sizes)), cuts)
        begin = (ends - sizes)[doc] + SEGMENT * (np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts))
        stop = np.minimum(begin + SEGMENT, ends[doc])
        start = np.maximum(begin - (self.order - 1), (ends - sizes)[doc])  # tokens that only set the state
        order = np.argsort(start - stop, kind="stable")
        doc, begin, stop, at = doc[order], begin[order], stop[order], start[order].copy()
        longest = stop - at
        score = np.zeros(len(doc))
        held = np.zeros(len(doc), dtype=np.int64)  # the carried state: so many tokens of history
        for step in range(int(longest[0]) if len(longest) else 0):
            live = int(np.searchsorted(-longest, -step, side="left"))  # segments are in order of length
            t, h, gain = at[:live] + step, held[:live], np.zeros(live)
            open_ = np.ones(live, dtype=bool)
            reached = np.zeros(live, dtype=np.int64)
            for k in range(self.order - 1, -1, -1):
                i = np.flatnonzero(open_ & (h >= k))
                if not len(i):
                    continue
                arc = places[k][t[i]]
                w = np.where(arc >= 0, self.weight[k][arc], -np.inf)
                hit = np.isfinite(w)
                gain[i[hit]] += w[hit]
                reached[i[hit]] = k + 1
                open_[i[hit]] = False
                if k:
                    fall = i[~hit]
                    gain[fall] += self.fall[k - 1][places[k - 1][t[fall] - 1]]
            scored = t >= begin[:live]
            score[:live][scored] += gain[scored]
            after = np.zeros(live, dtype=np.int64)
            for k in range(1, self.order):
                i = np.flatnonzero(reached >= k)
                p = places[k - 1][t[i]]
                yes = (p >= 0) & self.state[k - 1][p]
                after[i[yes]] = k
            held[:live] = after
        return np.bincount(doc, weights=score, minlength=len(sizes)), single, known


def score_documents(docs: DataFrame, held: str = "held", order: int = ORDER, min_count: int = MIN_COUNT) -> DataFrame:
    """Scores docs (doc_id, text and the boolean column held), learning from rows that aren't held out.

    The result has doc_id, held_out, n_tokens, n_known, base_score, score and train_tokens;
    other columns of docs are not read.
    """
    scratch = Scratch(docs.sparkSession, "backoff-lm")
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    blocks = scratch.keep(encode(docs.select("doc_id", text.alias("text"), F.coalesce(F.col(held), F.lit(False)).alias("held"))), "blocks")
    all_tokens = F.expr("aggregate(sizes, 0L, (a, x) -> a + x)")
    n_blocks, n_keys, n_tokens, n = blocks.agg(F.count("*"), *(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_keys", all_tokens, "n_train"))).first()
    slots = docs.sparkSession.sparkContext.defaultParallelism
    word_parts, gram_parts = (max(slots, -(-x // PART_KEYS)) for x in (n_keys, n_tokens // 2))
    told = scratch.keep(resolve_words(word_packs(blocks, word_parts), word_parts, min_count), "words")
    blocks = blocks.drop("keys")
    v = sum(int(unpacked(r["value"], np.float64)[1]) for r in told.filter(F.col("block") == TOTALS).select("value").toLocalIterator())
    sketched = min_count > 1
    if order > 1:
        if sketched:
            told = told.unionByName(scratch.keep(marked(blocks, told, n_blocks, order, gram_parts, min_count), "marks"))
        counts = []
        for level in range(1, order):
            packs = gram_packs(blocks, told, n_blocks, level, gram_parts, min_count, sketched)
            counts.append(scratch.keep(resolve_grams(packs, gram_parts, word_parts, min_count), f"counts{level}"))
        counts = reduce(DataFrame.unionByName, counts)
        asked = state_packs(blocks, told, n_blocks, order, word_parts, min_count, sketched)
        masses = scratch.keep(resolve_masses(asked, counts.filter(F.col("block") == MASSES), word_parts), "masses")
        told = told.unionByName(counts).unionByName(masses)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block(left.to_pylist()[0], min_count)
        block.take(right.to_pylist(), order, sketched)
        total, single, known = Automaton(block.levels, n, v, min_count).run(block.sizes)
        ids, flags = (left[c].combine_chunks().flatten() for c in ("doc_ids", "held"))
        return pa.table({"doc_id": ids, "held_out": flags, "n_tokens": block.sizes, "n_known": known, "base_score": single, "score": total})

    out = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    scored = by_block(blocks, told, n_blocks, score, out)
    return scored.withColumn("train_tokens", F.lit(n).cast("long"))
