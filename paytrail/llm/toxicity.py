"""Toxicity by a factorisation machine over hashed terms.

Terms are the words, lower-cased and without the ASCII punctuation around them, and
the first bytes of words, so that an insult is known in every inflection.  A
term's presence in the text is what counts: one insult weighs the same in a text of
any length.  The pair terms let an insult and a mention of a group add up to more
than either, which linear weights can't say.

Defined results: null and empty texts have no terms and get the score of the bias
alone.  Labels that are null or not 0 or 1 are left out of the fit; of several
labels of a document the greatest counts.  score() gives all columns of docs; its own, score
and predicted, replace such columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fm
from .common import remainder
from .textkernels import mix, span_hashes, split_words

THRESHOLD = 0.3
SETTINGS = fm.Settings()
#: Bytes at the head of a word that are a term too.
PREFIXES = (4, 5, 6)
IS_PUNCTUATION = np.zeros(256, dtype=bool)
IS_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def trim(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word limits without the ASCII punctuation on either side; words of it alone become empty."""
    if not len(starts):
        return starts.copy(), ends.copy()
    plain, at = ~IS_PUNCTUATION[data], np.arange(len(data))
    following = np.minimum.accumulate(np.where(plain, at, len(data))[::-1])[::-1]
    leading = np.maximum.accumulate(np.where(plain, at, -1))
    first = np.minimum(following[starts], ends)
    return first, np.maximum(leading[ends - 1] + 1, first)


def terms(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    words = split_words(texts)
    starts, ends = trim(words.lowered, words.starts, words.ends)
    kept = ends > starts
    starts, ends, owner = starts[kept], ends[kept], words.owner()[kept]
    texts, buckets = [owner], [fm.to_buckets(span_hashes(words.lowered, starts, ends))]
    for n in PREFIXES:
        long = ends - starts >= n
        heads = span_hashes(words.lowered, starts[long], starts[long] + n)
        texts.append(owner[long])
        buckets.append(fm.to_buckets(mix(heads + np.uint64(n))))
    return np.concatenate(texts), np.concatenate(buckets)


def score(docs: DataFrame, labels: DataFrame, train: DataFrame | None = None, settings: fm.Settings = SETTINGS) -> DataFrame:
    """docs with score and predicted; labels (doc_id, label) are those that may be learned from."""
    machine = fm.fit((train if train is not None else docs).select("doc_id", "text"), labels, terms, settings)
    return fm.apply(docs, machine, terms).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def held_out_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted); a fourth of the documents never serves to learn."""
    known = labels.filter(remainder(F.col("doc_id"), 4) != 2).select("doc_id", F.col("toxic").alias("label"))
    scored = score(docs.select("doc_id", "text"), known)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")
