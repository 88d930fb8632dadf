"""Text quality by a factorisation machine over hashed words, structure statistics and metadata.

Features of a text: its words (lower-cased, with the punctuation they carry), the
bins of statistics of its form, and the bin of its length, which is the metadata that
the text itself carries.  Pairs of these, such as capitals with exclamation marks,
are learned by the factors.

Defined results: null and empty texts have no words and the lowest bin of every
statistic.  Labels that are null or not 0 or 1 are left out of the fit.  score() gives all
columns of docs; its own two replace columns of their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fm
from .common import remainder
from .textkernels import Words, mix, split_words, word_hashes

THRESHOLD = 0.3
SETTINGS = fm.Settings()
#: Bin limits of shares, and of lengths.
SHARES = np.array([0.001, 0.003, 0.006, 0.01, 0.02, 0.04, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8])
LENGTHS = 2.0 ** np.arange(1, 24)


def _byte_share(words: Words, of: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(of)))
    size = np.maximum(np.diff(words.text_ends), 1)
    return (total[words.text_ends[1:]] - total[words.text_ends[:-1]]) / size


def _word_share(words: Words, of: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(of)))
    return (total[words.first[1:]] - total[words.first[:-1]]) / np.maximum(np.diff(words.first), 1)


def statistics(words: Words, hashes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(values, bin limits) for each statistic, a value for each text."""
    data, owner = words.data, words.owner()
    last = data[words.ends - 1] if len(words.ends) else data[:0]
    first = data[words.starts] if len(words.starts) else data[:0]
    size = words.ends - words.starts
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    n = np.diff(words.first)
    kinds = np.zeros(words.n_texts)
    if len(hashes):
        pairs = np.unique((owner.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
        kinds = np.bincount((pairs >> np.uint64(40)).astype(np.int64), minlength=words.n_texts)
    letters = ((data | 32) >= 97) & ((data | 32) <= 122)
    capital = (data >= 65) & (data <= 90)
    digit = (data >= 48) & (data <= 57)
    symbol = ~letters & ~digit & (data > 32) & (data < 127) & (data != 44) & (data != 46)
    shares = [
        _byte_share(words, capital),
        _byte_share(words, digit),
        _byte_share(words, symbol),
        _byte_share(words, data >= 128),
        _byte_share(words, data == 10),
        _word_share(words, again),
        _word_share(words, last == 33),
        _word_share(words, (size == 1) & ~letters[words.starts] if len(size) else size),
        _word_share(words, np.isin(last, np.frombuffer(b"*%&#$@~^=|", np.uint8))),
        _word_share(words, (first >= 65) & (first <= 90)),
        _word_share(words, (last == 46) | (last == 44)),
        _word_share(words, size >= 14),
        1 - kinds / np.maximum(n, 1),
    ]
    lengths = [n, np.diff(words.text_ends), np.diff(words.text_ends) / np.maximum(n, 1)]
    return [(x, SHARES) for x in shares] + [(x, LENGTHS) for x in lengths]


def features(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    words = split_words(texts)
    hashes = word_hashes(words)
    all_texts = np.arange(words.n_texts)
    found = statistics(words, hashes)
    bins = [np.searchsorted(limits, values, side="right") + 64 * k for k, (values, limits) in enumerate(found)]
    text = np.concatenate((words.owner(), np.tile(all_texts, len(bins))))
    key = np.concatenate((hashes, mix(np.concatenate(bins).astype(np.uint64) + np.uint64(1 << 40))))
    return text, fm.to_buckets(key)


def fit(docs: DataFrame, labels: DataFrame, settings: fm.Settings = SETTINGS) -> fm.Machine:
    """Learns from labels (doc_id, label), label 1 for good texts."""
    return fm.fit(docs.select("doc_id", "text"), labels, features, settings)


def score(docs: DataFrame, machine: fm.Machine, name: str = "score", predicted: str = "predicted") -> DataFrame:
    """docs with two more columns, the score and whether it reaches the threshold."""
    return fm.apply(docs, machine, features, name).withColumn(predicted, (F.col(name) >= THRESHOLD).cast("int"))


def learnable(labels: DataFrame) -> DataFrame:
    """The labels of documents that aren't held out: four fifths."""
    return labels.filter(remainder(F.col("doc_id"), 5) != 0).select("doc_id", F.col("quality").alias("label"))


def held_out_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted); a fifth of the documents never serves to learn."""
    docs = docs.select("doc_id", "text")
    scored = score(docs, fit(docs, learnable(labels)))
    return scored.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")
