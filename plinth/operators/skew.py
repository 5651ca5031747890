"""Joins whose key may be hot on both sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.runtime import large, spread

BLOCK = 4096  # rows of one side that meet in one place


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_tie: str, right_tie: str, block: int = BLOCK) -> DataFrame:
    """Inner equi-join that deals the pairs of a hot key to many tasks.

    Rows per key are counted on both sides. Where a key makes more than ``block`` squared pairs, each side is split into
    parts of about ``block`` rows by a hash of its tie column, and rows are repeated once per part of the other side.
    All other keys, usually every one, are joined without a copy. Both inputs are read twice, the first time for counts only.
    Neither is broadcast, since rows that unfolded before look small to the planner.
    """
    on = list(on)
    sizes = lambda df, name: df.groupBy(*on).agg(F.count(F.lit(1)).alias(name))
    hot = sizes(left, "_n").join(large(sizes(right, "_m")), on).where(F.col("_n") * F.col("_m") > block * block).select(
        *on, F.ceil(F.col("_n") / block).cast("int").alias("_ln"), F.ceil(F.col("_m") / block).cast("int").alias("_rn"))

    def dealt(df: DataFrame, tie: str, own: str, other: str) -> DataFrame:
        parts = F.coalesce(F.col(f"{own}n"), F.lit(1))
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(f"{other}n"), F.lit(1)) - 1))
        return df.join(hot, on, "left").withColumn(own, F.pmod(F.xxhash64(tie), parts).cast("int")).withColumn(other, copies).drop("_ln", "_rn")

    key = [*on, "_l", "_r"]
    sides = [spread(side, *key) for side in (dealt(left, left_tie, "_l", "_r"), dealt(right, right_tie, "_r", "_l"))]
    return sides[0].join(large(sides[1]), key).drop("_l", "_r")
