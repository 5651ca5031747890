"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.runtime import cut, discard


def _round(edges: DataFrame) -> DataFrame:
    """Hang every neighbour on the smallest one: first over larger neighbours, then over smaller ones.

    Both halves emit at most one edge per edge, so a hub costs its degree, never its square.
    """
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    large = cut(large.distinct())
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(low, "u")
    small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
    result = cut(small.where("u <> v").distinct())
    discard(large)
    return result


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` -> ``(id, component)`` for every node, component being its smallest reachable id.

    Loops and repeated edges are harmless; null ends must not occur. The rounds end when the edges are stars that no
    longer change, which takes a number of rounds that follows the logarithm of the longest chain.
    """
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
        last, edges = edges, _round(edges)
        discard(last)
    leaves = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
