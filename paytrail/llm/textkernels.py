"""Array kernels over batches of texts, run inside Spark tasks.

A batch of strings is laid out as one byte buffer, and words, their hashes and
rolling windows are computed for the whole buffer at once with numpy.  Words are
maximal runs of bytes other than space and U+0009..U+000D, which is the same
as the pattern ``[^\\x20\\x09-\\x0D]+`` because every byte of a multi-byte UTF-8
character is above 0x7F.  A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# The multiply-xorshift finaliser published with SplitMix64.
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
#: Odd base of the polynomial word hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit scrambling of unsigned values."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_A
    x ^= x >> np.uint64(27)
    x *= MIX_B
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


@dataclass
class Words:
    """Words of a batch: byte buffer, word limits and the words of each text."""

    data: np.ndarray  # uint8, the texts end to end
    lowered: np.ndarray  # data with A-Z lower-cased
    text_ends: np.ndarray  # limits of text i in data: [i], [i + 1]
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # words of text i: first[i] .. first[i + 1]

    @property
    def n_texts(self) -> int:
        return len(self.first) - 1

    def owner(self) -> np.ndarray:
        """Index of the text that each word belongs to."""
        return np.repeat(np.arange(self.n_texts), np.diff(self.first))


def layout(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and limits of an Arrow string column; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    _, offsets, data = texts.buffers()
    limits = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[limits[0] : limits[-1]], limits - limits[0]


def split_words(texts: pa.Array) -> Words:
    """Finds the words of all texts of a batch."""
    data, limits = layout(texts)
    space = IS_SPACE[data]
    before = np.ones(len(data), dtype=bool)
    before[1:] = space[:-1]
    inner = limits[:-1][limits[:-1] < len(data)]
    before[inner] = True
    starts = np.flatnonzero(before & ~space)
    after = np.ones(len(data), dtype=bool)
    after[:-1] = space[1:]
    cut = limits[1:]
    after[cut[cut > 0] - 1] = True
    ends = np.flatnonzero(after & ~space) + 1
    first = np.searchsorted(starts, limits)
    return Words(data, LOWER[data], limits, starts, ends, first)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """64-bit hash of data[start:end] for each span; spans are in order and don't overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, base + block, side="right")))
        top = ends[stop - 1]
        n = int(top - base)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data[base:top].astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
        s, e = starts[at:stop] - base, ends[at:stop] - base
        out[at:stop] = mix((total[e] - total[s]) * powers(BASE_INVERSE, n + 1)[s] + (e - s).astype(np.uint64))
        at = stop
    return out


def word_hashes(words: Words, lower: bool = True) -> np.ndarray:
    return span_hashes(words.lowered if lower else words.data, words.starts, words.ends)


def gram_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Hash of tokens[i:i + size] at each i; the last size - 1 positions have none."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(BASE) + tokens[k : k + n]
    return mix(out)


def batches(stream: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.Table]:
    """Regroups a task's Arrow batches so that each holds about most_bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in stream:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            got = part.column(batch.schema.get_field_index(column))
            n = int(layout(got)[1][-1])
            if held and size + n > most_bytes:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(part)
            size += n
    if held:
        yield pa.Table.from_batches(held)
