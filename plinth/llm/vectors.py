"""Vectors as the searches take them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, key: str, column: str, zeros: bool = True, repeats: bool = False) -> DataFrame:
    """``id, vector array<double>`` of the rows that take part.

    Out stay rows with a null id, a null vector, or a component that is null or not finite, and without ``zeros`` those
    whose components are all zero, empty ones included. Of rows with the same id the one with the smallest vector counts,
    unless ``repeats`` keeps them all.
    """

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("vector"))
    fine = rows.where(F.col("id").isNotNull() & F.forall("vector", finite))
    if not zeros:
        fine = fine.where(F.exists("vector", lambda x: x != 0))
    return fine if repeats else fine.groupBy("id").agg(F.min("vector").alias("vector"))
