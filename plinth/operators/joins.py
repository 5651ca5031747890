"""Keyed joins of the placement tables that need more than one DataFrame call."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.operators.filters import close
from plinth.operators.ordering import Ordered
from plinth.plans import dimensions as D


def role_rows(samples: DataFrame, fields: list[str], keep: list[str]) -> DataFrame:
    """Two-role samples to one row per role: columns ``anchor_f``/``placed_f`` become ``f``."""
    each = F.array(*[
        F.struct(F.lit(role).alias("role"), *[F.col(f"{role}_{f}").alias(f) for f in fields]) for role in D.ROLES
    ])
    return samples.select(*keep, F.explode(each).alias("r")).select(*keep, "r.*")


def role_columns(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Inverse of ``role_rows``: one row per key, a column per role and field, in one aggregate."""
    return rows.groupBy(key).agg(*[
        F.max(F.when(F.col("role") == role, F.col(f))).alias(f"{role}_{f}") for role in D.ROLES for f in fields
    ])


def updated(samples: DataFrame, changes: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Samples with non-null fields of ``changes`` taking precedence."""
    renamed = changes.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    joined = samples.join(renamed, key, "left")
    return joined.withColumns({f: F.coalesce(f"_{f}", f) for f in fields}).drop(*[f"_{f}" for f in fields])


def latest_before(left: DataFrame, logs: DataFrame, key: str, time: str, cutoff: Column | str) -> DataFrame:
    """Newest log of each key strictly before a fixed cutoff; keys without one keep nulls."""
    others = [c for c in logs.columns if c != key]
    limit = F.lit(cutoff) if isinstance(cutoff, str) else cutoff
    newest = logs.where(F.col(time) < limit).groupBy(key).agg(F.max(F.struct(time, *[c for c in others if c != time])).alias("n"))
    return left.join(newest, key, "left").select(*left.columns, *[F.col(f"n.{c}").alias(c) for c in others])


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, value: str, tie: str) -> DataFrame:
    """Newest ``value`` of ``right`` strictly before each left row's time, per key, even where it is null.

    Both sides are merged by time and the value is carried forward through ``Ordered``, so a key
    with a third of all rows is still split into time ranges; nothing is paired. The left columns travel along, so
    ids need not be unique. Left rows with a null key or time find nothing.
    """
    kind = f"struct<v:{right.schema[value].dataType.simpleString()}>"
    whole = left.schema.simpleString()
    merge = lambda df, side, row, held: df.select(
        F.col(key).alias("_key"), F.col(time).alias("_time"), F.col(tie).alias("_tie"), F.lit(side).alias("_side"),
        row.alias("_row"), held.alias("_value"),
    )
    a = merge(left, 0, F.struct(*left.columns), F.lit(None).cast(kind))
    b = merge(right.where(F.col(time).isNotNull()), 1, F.lit(None).cast(whole), F.struct(F.col(value).alias("v")))
    # At equal times left rows come first, so only strictly earlier values reach them.
    merged = Ordered(a.unionByName(b), ["_time", "_side", "_tie"], by=["_key"]).last_before("_value", "_found").done()
    found = F.when(F.col("_key").isNotNull(), F.col("_found.v")).alias(value)
    return merged.where("_side = 0").select("_row.*", found)


def matching_pose(logs: DataFrame, baked: DataFrame, key: str, parts: list[str]) -> DataFrame:
    """Logs of a sample with ``current``: whether every pose part agrees with the baked one."""
    mine = baked.select(key, *[F.col(p).alias(f"_{p}") for p in parts])
    agree = reduce(lambda a, b: a & b, [close(F.col(p), F.col(f"_{p}")) for p in parts])
    return logs.join(mine, key, "left").withColumn("current", agree).drop(*[f"_{p}" for p in parts])


def with_fallback(base: DataFrame, first: DataFrame, second: DataFrame, key: str, value: str) -> DataFrame:
    """``value`` from the first source that has it, with ``provenance`` normalized/reference/none."""
    a = first.select(key, F.col(value).alias("_first"))
    b = second.select(key, F.col(value).alias("_second"))
    joined = base.join(a, key, "left").join(b, key, "left")
    provenance = F.when(F.col("_first").isNotNull(), "normalized").when(F.col("_second").isNotNull(), "reference").otherwise("none")
    return joined.withColumn(value, F.coalesce("_first", "_second")).withColumn("provenance", provenance).drop("_first", "_second")


def once_per_key(df: DataFrame, key: str, work) -> DataFrame:
    """Do ``work`` on distinct keys only, then hand the result to every row."""
    return df.join(work(df.select(key).distinct()), key)


def abandoned(missing: DataFrame, permanent: Column) -> DataFrame:
    """All missing jobs when every one of them is a permanent loss, else none.

    Both totals are one-row aggregates used as scalar subqueries.
    """
    count = missing.agg(F.count(F.lit(1)).alias("n")).scalar()
    return missing.where((permanent > 0) & (count == permanent))
