"""Connected components by alternating large-star and small-star steps, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.llm.common import kept


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node's closed neighbourhood."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("low"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionAll(least.select("u", F.col("low").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    """Number and order-free checksum of the edges: two numbers."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): of every node of ``edges`` (u, v), the smallest node it is linked with.

    Each round is a written table; the number of rounds grows with the logarithm of the
    longest chain. A node with very many neighbours only ever keeps one edge to its smallest.
    """
    now = kept(edges.where("u <> v").select("u", "v").distinct(), "links")
    state = _state(now)
    while state[0]:
        after = kept(_small_star(_large_star(now)), "links")
        state, before = _state(after), state
        now = after
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
