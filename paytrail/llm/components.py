"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Edges to a partition when a step's result is written.
EDGES_A_PART = 250_000
MOST_STEPS = 60


def _attach(pairs: DataFrame, low: DataFrame) -> DataFrame:
    return pairs.join(low, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour (or itself)."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _attach(both, low).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to its least neighbour; edges have a > b."""
    down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = _attach(down, low).filter("v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the least node that it reaches.

    Nodes are longs, edges have no direction; loops and repeated edges do no harm.
    Each step is written as a table, so lineage stays short; a node with any
    number of neighbours is only ever aggregated and joined, never gathered.
    """
    edges = edges.filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, mark = _written(edges, scratch, f"{name}-0")
    for step in range(1, MOST_STEPS + 1):
        after, new = _written(_small_star(_large_star(now)), scratch, f"{name}-{step}", parts=mark[0] // EDGES_A_PART + 1)
        scratch.drop(f"{name}-{step - 1}")
        now, done, mark = after, new == mark, new
        if done:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
    raise RuntimeError("the components did not settle")


def _written(edges: DataFrame, scratch: Scratch, name: str, parts: int | None = None) -> tuple[DataFrame, tuple[int, int]]:
    kept = scratch.keep(edges.coalesce(parts) if parts else edges, name)
    n, total = kept.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first()
    return kept, (n, int(total))
