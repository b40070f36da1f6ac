"""Distributed connected components over an edge table, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgrid.llm.common import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h"), F.sum(F.xxhash64("b", "a") % 1000003).alias("s")).first()
    return tuple(row)


def with_least(rows: DataFrame, least: DataFrame) -> DataFrame:
    """``rows(a, b)`` with the written minimum ``m`` of each ``a``."""
    return rows.join(least, "a")


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for each node of ``edges(a, b)``; the component is its smallest node.

    Alternating large-star and small-star rounds: each links a node's neighbours to its smallest neighbour
    and drops the old links, so the table never grows past the input's size and shrinks to stars in
    O(log^2 n) rounds. The minimum per node is a partially aggregated ``groupBy``, which is written before it is joined back: both
    sides of the join are then dealt for it alone, so that adaptive execution can split a hub's rows. Each round is
    written to the shared checkpoint folder too. Null ends and self-links are left out; repeated edges and either direction are allowed.
    """
    forward = edges.select("a", "b").where(F.col("a") != F.col("b"))
    stars = materialize(forward.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(stars)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = stars.union(stars.select("b", "a"))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = materialize(with_least(both.where(F.col("b") > F.col("a")), least).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")))
        small = with_least(large, least).where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = materialize(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        now = _state(stars)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
