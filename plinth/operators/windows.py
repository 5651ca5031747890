"""Order-dependent rules over feeds, logs and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.operators.ordering import Ordered, ranked


def newest(df: DataFrame, by: list[str], order: list[Column], n: int, out: str = "rn") -> DataFrame:
    """The ``n`` newest rows per key, numbered from 1.

    The rank filter becomes a per-task limit before the shuffle, so a hot key ships at most ``n``
    rows per task.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= n)


def recent_list(df: DataFrame, by: list[str], seq: str, value: str, n: int, out: str) -> DataFrame:
    """The last ``n`` values per key in order, joined by commas."""
    kept = newest(df, by, [F.col(seq).desc()], n)
    items = F.array_sort(F.collect_list(F.struct(seq, value)))
    return kept.groupBy(*by).agg(items.alias("_i")).select(*by, F.array_join(F.col(f"_i.{value}"), ", ").alias(out))


def batches(df: DataFrame, order: str, size: int) -> DataFrame:
    """Global batches of exactly ``size`` rows in ``order``: batch number and 1-based place."""
    numbered = ranked(df, [order], out="_rn")
    return numbered.select(
        "*", F.floor((F.col("_rn") - 1) / size).alias("batch"), ((F.col("_rn") - 1) % size + 1).alias("i")
    ).drop("_rn")


def local_batches(df: DataFrame, size: int) -> DataFrame:
    """Batches of at most ``size`` rows without any shuffle: ids count up inside each partition.

    For work that only needs bounded batches. Partition and offset are the two halves of the
    generated id.
    """
    shifted = df.withColumn("_id", F.monotonically_increasing_id())
    offset = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    batch = F.concat_ws("/", F.shiftright("_id", 33).cast("string"), F.floor(offset / size).cast("string"))
    return shifted.withColumn("batch", batch).withColumn("i", offset % size + 1).drop("_id")


def islands(feed: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Rows with ``island``: numbered stretches of an unchanged ``value`` per key; null is a value like others."""
    return Ordered(feed, order, by=by).stretches(value, "island").done()


def settled(feed: DataFrame, by: list[str], time: str, tie: str, value: str, threshold: Column) -> DataFrame:
    """Stretches of an unchanged, non-zero count that lasted longer than ``threshold`` (seconds)."""
    marked = islands(feed, by, [time, tie], value)
    spans = marked.groupBy(*by, "island").agg(
        F.first(value).alias(value), F.min(time).alias("since"), F.max(time).alias("until")
    )
    lasted = F.timestamp_diff("SECOND", F.col("since"), F.col("until"))
    return spans.withColumn("seconds", lasted).where((F.col(value) > 0) & (F.col("seconds") > threshold))


def verdicts(feed: DataFrame, by: list[str], time: str, tie: str, missing: Column, publish_grace: int,
             vanish_grace: int) -> DataFrame:
    """Stretches of missing state that outlast their grace period.

    A null state is not missing. Before anything was published the long grace applies (``never published``); afterwards the
    short one (``vanished``).
    """
    state = feed.withColumn("_missing", F.coalesce(missing.cast("int"), F.lit(0))).withColumn("_seen", 1 - F.col("_missing"))
    marked = Ordered(state, [time, tie], by=by).running_max("_seen", "published").stretches("_missing", "island").done()
    spans = marked.where("_missing = 1").groupBy(*by, "island").agg(
        F.max("published").alias("published"), F.min(time).alias("since"), F.max(time).alias("until")
    ).withColumn("seconds", F.timestamp_diff("SECOND", F.col("since"), F.col("until")))
    verdict = F.when((F.col("published") == 1) & (F.col("seconds") > vanish_grace), "vanished").when(
        (F.col("published") == 0) & (F.col("seconds") > publish_grace), "never published"
    )
    return spans.withColumn("verdict", verdict).where("verdict is not null")


def record_bounds(df: DataFrame, by: str, order: str, length: str) -> DataFrame:
    """Prefix-sum bounds of concatenated records: ``starts`` and ``ends`` per record."""
    summed = Ordered(df, [order], by=[by]).running_sum(length, "ends").done()
    return summed.withColumn("starts", F.col("ends") - F.col(length))
