"""Main text of web pages: a bidirectional LSTM labels every block of a page in view of all others.

A page is read into blocks (``blocks``); scripts, styles, form controls and other content that
is never text is left out there.  Each block becomes hashed tag-path tokens, hashed
words of its whole text, and a few numbers (length, links, place); the labeller
(``recurrent``) runs over a page's blocks in both directions and tells main text from
menus, headers, footers, sidebars, notices, adverts, forms and comments.

It is fitted on at most ``pages`` pages, those with the least hash of their content.
Pages that use article or main elements label their own blocks, and these blocks are also
put into layouts drawn at random (``layouts``), so that pages of other makes are told apart
too.  Fitting is iterative parameter mixing: every round sends the weights to the shards,
each of which runs Adam over its own pages in new layouts, and takes the mean.
Extraction is one pass without a shuffle.

Defined results: null html is empty and gives an empty text, as does a page without main
text; rows are kept one for one, repeated ones with equal results; an empty table gives none
(and is fitted by nothing).  Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import PATH_BUCKETS, Block, read_blocks
from .common import Scratch
from .layouts import relay, weak_labels
from .recurrent import NUMBERS, Adam, Items, gradients, margins, new_weights
from .textkernels import batches, split_words, word_hashes

WORD_BUCKETS = 4096
BATCH_BYTES = 2 << 20


@dataclass(frozen=True)
class Settings:
    pages: int = 240  # to learn from, at most
    shards: int = 4
    rounds: int = 5
    lessons: int = 540  # of a shard in each round; its pages, each also in new layouts, as many as that takes
    batch: int = 16
    rate: float = 0.02
    most_blocks: int = 400  # of a page that is learned from


def featurise(pages: list[list[Block]]) -> Items:
    flat = [b for page in pages for b in page]
    words = split_words(pa.array([b.text for b in flat], pa.large_string()))
    hashes = (word_hashes(words) & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
    paths = [sorted(b.path) for b in flat]
    numbers = np.zeros((len(flat), NUMBERS), np.float32)
    at = 0
    for page in pages:
        n = len(page)
        for i, b in enumerate(page):
            size = len(b.text)
            numbers[at + i] = (np.log1p(size) / 6, np.log1p(b.text.count(" ")) / 4, b.linked / size, min(1, 20 * sum(map(b.text.count, ".,;!?")) / size), (i + 1) / n, i == 0, i == n - 1, b.tag in {"h1", "h2"})
        at += n
    limits = np.concatenate(([0], np.cumsum([len(p) for p in paths]))).astype(np.int64)
    return Items(np.fromiter((x for p in paths for x in p), np.int64, limits[-1]), limits, hashes, words.first, numbers, np.array([len(p) for p in pages], np.int64))


def lessons(page: str, seed: int, use: Settings, layouts: int = 8) -> Iterator[tuple[list[Block], list[int]]]:
    """A page with the labels that it gives away, and its blocks in other layouts."""
    own = read_blocks(page)[: use.most_blocks]
    if not own:
        return
    labels = weak_labels(own)
    yield own, labels
    for i in range(layouts):
        pick = random.Random(f"{seed} {i} {zlib.crc32(page.encode())}")
        made = relay(own, labels, pick)
        if made:
            again = read_blocks("".join(made[0]))
            if len(again) == len(made[1]):
                yield again, made[1]


def learn(weights: dict, taught: list[tuple[list[Block], list[int]]], use: Settings, seed: int) -> None:
    """One pass over the lessons, in an order that seed fixes."""
    pick = np.random.default_rng(seed)
    # Lessons of like length go together, so that little is padding.
    order = np.argsort([len(y) for _, y in taught] + pick.uniform(0, 6, len(taught)))
    adam = Adam(weights, use.rate / (1 + seed / 2))
    for at in pick.permutation(range(0, len(order), use.batch)):
        own = [taught[i] for i in order[at : at + use.batch]]
        _, grad = gradients(weights, featurise([b for b, _ in own]), np.concatenate([y for _, y in own]).astype(np.float32))
        adam.step(grad)


def fit(pages: DataFrame, use: Settings = Settings()) -> dict[str, np.ndarray]:
    """Weights learned from pages (html)."""
    scratch = Scratch(pages.sparkSession, "labeller")
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    hashed = pages.select(html).withColumn("hash", F.xxhash64("html")).filter("html <> ''")
    # Equal pages are one; the least hashes are found before any page is moved.
    least = hashed.select("hash").distinct().orderBy("hash").limit(use.pages)
    chosen = hashed.join(F.broadcast(least), "hash").groupBy("hash").agg(F.min("html").alias("html"))
    sample = scratch.keep(chosen.repartition(use.shards, "hash"), "sample")
    weights = new_weights(PATH_BUCKETS, WORD_BUCKETS)
    names, shapes = list(weights), [w.shape for w in weights.values()]

    for turn in range(use.rounds):

        def run(stream: Iterator[pa.RecordBatch], turn: int = turn) -> Iterator[pa.RecordBatch]:
            own_pages = [page for batch in stream for page in batch.column("html").to_pylist()]
            taught = [lesson for page in own_pages for lesson in lessons(page, turn, use, use.lessons // len(own_pages))]
            if taught:
                own = {k: w.copy() for k, w in weights.items()}
                learn(own, taught, use, turn)
                flat = np.concatenate([w.ravel() for w in own.values()])
                yield pa.RecordBatch.from_arrays([pa.array([len(taught)]), pa.array([flat.tobytes()], pa.binary())], names=["n", "flat"])

        got = sample.select("html").mapInArrow(run, "n long, flat binary").collect()  # one row of a shard's weights
        if not got:
            break
        n = sum(r["n"] for r in got)
        flat = sum(np.float32(r["n"] / n) * np.frombuffer(r["flat"], np.float32) for r in got)
        ends = np.cumsum([int(np.prod(s)) for s in shapes])
        weights = {k: part.reshape(s).copy() for k, s, part in zip(names, shapes, np.split(flat, ends[:-1]), strict=True)}
    scratch.drop("sample")
    return weights


def main_texts(weights: dict, pages: list[str]) -> list[str]:
    read = [read_blocks(page) for page in pages]
    if not any(read):
        return ["" for _ in read]
    keep = margins(weights, featurise(read)) > 0
    out, at = [], 0
    for page in read:
        out.append("\n\n".join(b.text for b, k in zip(page, keep[at : at + len(page)], strict=True) if k))
        at += len(page)
    return out


def extract(pages: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page."""
    schema = pages.select("page_id", F.col("url").cast("string").alias("url"))
    shared = pages.sparkSession.sparkContext.broadcast(weights)  # of a fixed size, about 0.4 MB

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches(stream, "html", BATCH_BYTES):
            texts = main_texts(shared.value, table["html"].to_pylist())
            columns = [table["page_id"], table["url"], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
            yield from pa.table(columns, names=["page_id", "url", "text", "n_chars"]).combine_chunks().to_batches()

    kind = schema.schema.add("text", "string").add("n_chars", "long")
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    return pages.select("page_id", F.col("url").cast("string").alias("url"), html).mapInArrow(run, kind)
