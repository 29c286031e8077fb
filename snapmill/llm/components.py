"""Connected components of an edge table by alternating large and small stars.

Every round is an aggregation and a join over the remaining edges, written to the shared folder; edges
and labels never reach the driver. The number of rounds grows with the logarithm of the graph's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmill.runtime import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _star(pairs: DataFrame) -> DataFrame:
    """pairs (u, v) with the smallest member m of u and its v's."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the edges (a, b); root is the smallest node reachable."""
    edges = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        large = _star(_both_ways(edges)).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        small = _star(large.select(F.col("a").alias("u"), F.col("b").alias("v")))
        edges = materialize(small.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
                            .unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components: not settled after {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
