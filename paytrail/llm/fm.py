"""Factorisation machines over hashed features, fitted and applied as Spark jobs.

    score(x) = sigmoid(b + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j)

The pair term is computed in linear time from the sum-of-squares identity,
half of (sum v_i x_i)^2 - sum (v_i x_i)^2 for each factor.  Features are binary.

Fitting takes at most ``rows`` labelled documents, those with the least hash of
their identifier.  A first job counts, for each hash bucket, the documents of
either class; the buckets whose chi-square against the label is significant
become features.  Then the machine is fitted by iterative parameter mixing: each
round sends the current parameters to the shards of the training table, every
shard runs mini-batch AdaGrad over its rows, and the shards' parameters are
averaged, weighted by rows.  What reaches the driver is one parameter set from
each shard, whatever the data's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch
from .textkernels import batches

BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
BATCH_BYTES = 1 << 20

#: Texts to (text index, bucket) of the features that a text has, in any order, repeats included.
Featurise = Callable[[pa.ChunkedArray], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Settings:
    rows: int = 24_000  # labelled documents at most
    features: int = 4096  # buckets at most
    least_documents: int = 6  # in which a bucket must occur
    least_chi2: float = 10.83  # 0.1 % for one degree of freedom
    factors: int = 8
    shards: int = 8
    rounds: int = 6
    batch: int = 128
    rate: float = 0.1
    decay: float = 1e-4


@dataclass
class Machine:
    slot: np.ndarray  # feature of each bucket, or -1
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def select(self, text: np.ndarray, bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Features in the machine, and the limits of each text's features among them."""
        known = self.slot[bucket] >= 0
        text, bucket = distinct_pairs(text[known], bucket[known])
        return self.slot[bucket], np.searchsorted(text, np.arange(n + 1))

    def margin(self, feature: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = self.factors[feature]
        one = np.concatenate((self.weights[feature, None], v, v * v), axis=1)
        total = segment_sums(one, limits)
        k = self.factors.shape[1]
        return self.bias + total[:, 0] + 0.5 * (total[:, 1 : k + 1] ** 2 - total[:, k + 1 :]).sum(axis=1), total[:, 1 : k + 1]

    def fit(self, feature: np.ndarray, limits: np.ndarray, label: np.ndarray, use: Settings, seed: int) -> None:
        """One pass of mini-batch AdaGrad over the rows, in an order that seed fixes."""
        state = [np.full(self.weights.shape, 1e-2), np.full(self.factors.shape, 1e-2), 1e-2]
        order = np.random.default_rng(seed).permutation(len(label))
        for at in range(0, len(order), use.batch):
            rows = order[at : at + use.batch]
            sizes = np.diff(limits)[rows]
            ends = np.cumsum(sizes)
            pick = np.repeat(limits[rows] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
            ids, where = np.unique(feature[pick], return_inverse=True)
            cut = np.concatenate(([0], ends))
            margin, sums = self.margin(feature[pick], cut)
            gap = sigmoid(margin) - label[rows]
            owner = np.repeat(np.arange(len(rows)), sizes)
            n = max(len(rows), 1)
            g_w = np.bincount(where, weights=gap[owner], minlength=len(ids)) / n + use.decay * self.weights[ids]
            g_v = np.zeros((len(ids), self.factors.shape[1]))
            for f in range(g_v.shape[1]):
                g_v[:, f] = np.bincount(where, weights=gap[owner] * sums[owner, f], minlength=len(ids)) / n
            g_v += (use.decay - np.bincount(where, weights=gap[owner], minlength=len(ids)) / n)[:, None] * self.factors[ids]
            state[0][ids] += g_w * g_w
            state[1][ids] += g_v * g_v
            state[2] += gap.mean() ** 2
            self.weights[ids] -= use.rate * g_w / np.sqrt(state[0][ids])
            self.factors[ids] -= use.rate * g_v / np.sqrt(state[1][ids])
            self.bias -= use.rate * gap.mean() / np.sqrt(state[2])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def segment_sums(values: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Sums of values[limits[i]:limits[i + 1]], zero where that is empty."""
    out = np.zeros((len(limits) - 1, *values.shape[1:]))
    full = np.flatnonzero(np.diff(limits))
    if len(full):
        out[full] = np.add.reduceat(values, limits[:-1][full], axis=0)
    return out


def distinct_pairs(text: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique((text.astype(np.int64) << BUCKET_BITS) | bucket)
    return pairs >> BUCKET_BITS, pairs & (BUCKETS - 1)


def to_buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)


def labelled_sample(docs: DataFrame, labels: DataFrame, use: Settings) -> DataFrame:
    """(text, label): at most use.rows documents, equal texts once (with the greater label)."""
    one = labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(use.rows)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.join(F.broadcast(sample), "doc_id").select(text.alias("text"), "label").groupBy("text").agg(F.max("label").alias("label"))


def count_buckets(train: DataFrame, featurise: Featurise) -> DataFrame:
    """(bucket, n, n1): documents with the bucket, and those of label 1 among them."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, n1 = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches(stream, "text", BATCH_BYTES):
            text, bucket = distinct_pairs(*featurise(batch["text"]))
            label = batch["label"].to_numpy().astype(bool)
            n += np.bincount(bucket, minlength=BUCKETS)
            n1 += np.bincount(bucket[label[text]], minlength=BUCKETS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array(n1[at])], names=["bucket", "n", "n1"])

    parts = train.mapInArrow(run, "bucket long, n long, n1 long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))


def choose_features(counts: DataFrame, rows: int, ones: int, use: Settings) -> list[int]:
    """Buckets with the greatest chi-square; at most use.features reach the driver."""
    a, n = F.col("n1").cast("double"), F.col("n").cast("double")
    apart = a * (rows - ones) - (n - a) * ones
    chi2 = F.lit(float(rows)) * apart * apart / (n * (rows - n) * float(ones) * float(rows - ones))
    kept = counts.filter((F.col("n") >= use.least_documents) & (F.col("n") < rows)).select("bucket", chi2.alias("chi2"))
    best = kept.filter(F.col("chi2") >= use.least_chi2).orderBy(F.desc("chi2"), "bucket").limit(use.features)
    return sorted(r["bucket"] for r in best.collect())


def fit(docs: DataFrame, labels: DataFrame, featurise: Featurise, use: Settings = Settings()) -> Machine:
    """A machine for label from docs (doc_id, text) and labels (doc_id, label).

    Without rows of both classes the score is the same for every text: the share of
    label 1, or one half if there are no rows.
    """
    scratch = Scratch(docs.sparkSession, "factorisation")
    train = scratch.keep(labelled_sample(docs, labels, use).repartition(use.shards), "train")
    rows, ones = train.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    share = (ones + 0.5) / (rows + 1)
    buckets = choose_features(count_buckets(train, featurise), rows, ones, use) if 0 < ones < rows else []
    slot = np.full(BUCKETS, -1, dtype=np.int32)
    slot[buckets] = np.arange(len(buckets))
    start = np.random.default_rng(7).normal(0, 0.05, (len(buckets), use.factors))
    machine = Machine(slot, float(np.log(share / (1 - share))), np.zeros(len(buckets)), start)
    if not buckets:
        return machine
    encoded = scratch.keep(_encode(train, featurise, machine), "encoded")
    for turn in range(use.rounds):
        _mix(encoded, machine, use, turn)
    scratch.drop("train", "encoded")
    return machine


def _encode(train: DataFrame, featurise: Featurise, machine: Machine) -> DataFrame:
    """One row for each batch of documents: labels, limits and features as arrays of bytes."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, "text", BATCH_BYTES):
            feature, limits = machine.select(*featurise(batch["text"]), batch.num_rows)
            arrays = [batch["label"].to_numpy().astype(np.int8), limits.astype(np.int64), feature.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in arrays], names=["label", "limits", "feature"])

    return train.mapInArrow(run, "label binary, limits binary, feature binary")


def _mix(encoded: DataFrame, machine: Machine, use: Settings, turn: int) -> None:
    """One round: every partition fits a copy of the machine, and the copies are averaged."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, limits, features = [], [np.zeros(1, np.int64)], []
        for batch in stream:
            for row in batch.to_pylist():
                labels.append(np.frombuffer(row["label"], np.int8))
                limits.append(np.frombuffer(row["limits"], np.int64)[1:] + limits[-1][-1])
                features.append(np.frombuffer(row["feature"], np.int32))
        if labels:
            own = Machine(machine.slot[:0], machine.bias, machine.weights.copy(), machine.factors.copy())
            label = np.concatenate(labels).astype(float)
            own.fit(np.concatenate(features), np.concatenate(limits), label, use, turn)
            flat = np.concatenate(([own.bias], own.weights, own.factors.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array([len(label)]), pa.array([flat.tobytes()], pa.binary())], names=["n", "flat"])

    got = encoded.mapInArrow(run, "n long, flat binary").collect()
    n = sum(r["n"] for r in got)
    flat = sum(r["n"] / n * np.frombuffer(r["flat"]) for r in got)
    machine.bias = float(flat[0])
    machine.weights = flat[1 : 1 + len(machine.weights)].copy()
    machine.factors = flat[1 + len(machine.weights) :].reshape(machine.factors.shape).copy()


def apply(docs: DataFrame, machine: Machine, featurise: Featurise, name: str = "score") -> DataFrame:
    """docs, which has a column text, with the score of each whole text, in place of a column of that name; no shuffle."""
    if name.lower() in {"doc_id", "text"}:
        raise ValueError(f"a score can't be named {name}")
    docs = docs.drop(name)
    names = docs.columns
    at = next(i for i, c in enumerate(names) if c.lower() == "text")
    # By place, since not every name of a column can be said where the rows go through Python.
    docs = docs.toDF(*("text" if i == at else f"c{i}" for i in range(len(names))))
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, "text", BATCH_BYTES):
            feature, limits = machine.select(*featurise(batch["text"]), batch.num_rows)
            score = sigmoid(machine.margin(feature, limits)[0])
            yield from batch.append_column("score", pa.array(score)).combine_chunks().to_batches()

    return docs.mapInArrow(run, schema).toDF(*names, name)
