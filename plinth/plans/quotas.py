"""Proportional quotas and shortfalls over the category x complexity grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plinth.plans.dimensions import categories, kinds


def category_quotas(spark: SparkSession, total: Column | int) -> DataFrame:
    """Largest-remainder split of ``total`` by weight; ties keep the category order.

    ``total`` may be a scalar-subquery Column. All windows run over the six category rows.
    """
    total = F.lit(total) if isinstance(total, int) else total
    every = Window.partitionBy(F.lit(0))
    shares = categories(spark).select(
        "ord", "category", total.cast("long").alias("total"),
        (total * F.col("weight") / F.sum("weight").over(every)).alias("exact"),
    ).withColumn("base", F.floor("exact"))
    ranked = shares.select(
        "*",
        F.row_number().over(every.orderBy((F.col("exact") - F.col("base")).desc(), "ord")).alias("place"),
        (F.col("total") - F.sum("base").over(every)).alias("spare"),
    )
    extra = F.when(F.col("place") <= F.col("spare"), 1).otherwise(0)
    return ranked.select("ord", "category", (F.col("base") + extra).cast("long").alias("quota"))


def quotas(spark: SparkSession, total: Column | int) -> DataFrame:
    """Quota per (category, complexity): each category halved, the simple half taking the odd one."""
    half = F.when(F.col("complexity") == "simple", F.ceil(F.col("quota") / 2)).otherwise(F.floor(F.col("quota") / 2))
    grid = kinds(spark).select("category", "kind_ord", "complexity", "relations", "levels")
    return category_quotas(spark, total).join(F.broadcast(grid), "category").withColumn("quota", half.cast("long"))


def kind_of(complexity: Column) -> Column:
    """A sample without a recorded complexity was written in the complex style."""
    return F.when(complexity == "simple", "simple").otherwise("complex")


def created_counts(samples: DataFrame) -> DataFrame:
    """Samples per (category, complexity); at most twelve rows come out of the partial counts."""
    return samples.groupBy("category", kind_of(F.col("complexity")).alias("complexity")).agg(
        F.count(F.lit(1)).alias("created")
    )


def shortfall(quota: DataFrame, samples: DataFrame) -> DataFrame:
    """What is still missing per kind, zero rows included."""
    created = F.coalesce("created", F.lit(0)).cast("long")
    joined = quota.join(created_counts(samples), ["category", "complexity"], "left")
    return joined.withColumn("created", created).withColumn("short", F.greatest(F.lit(0), F.col("quota") - F.col("created")))
