"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.llm.common import stored


def _toward_minimum(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Point neighbours at the smallest node around: the larger ones (large star) or the smaller ones and itself (small star)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if larger_only else both.filter("b < a")
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = near.join(least, "a")
    if larger_only:
        out = moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for all nodes of the edges ``a, b`` (longs); the component is its smallest node.

    Each round points every node at smaller ones; the number of rounds grows with the logarithm of the
    largest distance. Minima are combined before they are shuffled, and a node with many links is only joined.
    """
    edges = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = state(edges)
    while before[0]:
        edges = stored(_toward_minimum(_toward_minimum(edges, True), False))
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
