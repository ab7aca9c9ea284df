"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truegrain.session import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the greater neighbours of every node on its least one."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    moved = both.where("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the least of them; ``a > b`` in all edges."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, of all nodes with an edge.

    ``edges`` has columns ``a`` and ``b``. Stars are made by turns until nothing changes;
    each round is written to the shared folder. A node of many edges shrinks by partial
    minima before the shuffle, and its join is one that the adaptive plan can split.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    state = settle(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct())
    before = None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        state = settle(_small_star(_large_star(state)))
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
