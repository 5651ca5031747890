"""Incremental runs over growing folders: gap filling, de-duplication, sessions, progress counts, verdicts on silent keys.

State of sessions and counts is bounded by their watermark. ``watch`` needs the RocksDB state store provider; the others
run with any. Rows behind the watermark are never lost: ``watch`` and ``count_windows`` hand them out beside their results.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def folder(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """A growing folder of Parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there, append it to ``out`` exactly once, stop."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", out).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()


def fill_gaps(stream: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Run ``work`` on new rows only; finished ones are skipped by the checkpoint.

    Each micro-batch owns one folder that a replay overwrites, so a batch counts once even when
    its executor or the driver is lost half way.
    """
    def land(rows: DataFrame, batch: int) -> None:
        work(rows).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()


def timed(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as a zoned timestamp with a watermark (watermarks do not take zone-free ones)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def accept_once(stream: DataFrame, key: list[str], ts: str | None = None, remember: str | None = None) -> DataFrame:
    """First arrival of each key.

    A key is remembered for good, so the state grows with the keys; only a caller that knows when a key cannot come
    back names a time ``remember`` (by ``ts``), after which it would be accepted again.
    """
    if remember is None:
        return stream.dropDuplicates(key)
    return timed(stream, ts, remember).dropDuplicatesWithinWatermark(key)


def sessions(df: DataFrame, by: str, ts: str, gap: str, delay: str) -> DataFrame:
    """Bursts of activity per key: a key is settled once nothing arrives for ``gap``.

    ``delay`` is how late a row may come; later ones are dropped, so it is the caller's to choose. Where they must not
    be lost, use ``watch``.
    """
    grouped = timed(df, ts, delay).groupBy(F.session_window(ts, gap).alias("s"), by)
    return grouped.agg(F.count(F.lit(1)).alias("rows")).select(
        by, F.col("s.start").cast("timestamp_ntz").alias("since"), F.col("s.end").cast("timestamp_ntz").alias("until"), "rows"
    )


def progress(df: DataFrame, ts: str, width: str, kind: Column, delay: str) -> DataFrame:
    """Rows per kind and tumbling window; rows that come more than ``delay`` late are dropped."""
    grouped = timed(df, ts, delay).groupBy(F.window(ts, width).alias("w"), kind.alias("kind"))
    return grouped.agg(F.count(F.lit(1)).alias("rows")).select(F.col("w.start").cast("timestamp_ntz").alias("since"), "kind", "rows")


def count_windows(stream: DataFrame, ts: str, width: str, kind: Column, delay: str, out: str, checkpoint: str) -> None:
    """Rows per kind and tumbling window like ``progress``, with a side table for rows whose window had closed.

    A window closes once its end is ``delay`` behind the latest time seen in earlier batches. Every micro-batch owns a
    folder under each of ``out``'s tables and overwrites it: ``counts`` (partial sums, added up by ``counted``), ``late``
    (whole rows) and ``marks`` (the batch's latest time, one row). A batch reads the marks of the batches before it only,
    so a replay decides as the first run did. Counts and side table together hold each row once. Rows without a time
    are late.
    """
    spark = stream.sparkSession

    def land(rows: DataFrame, batch: int) -> None:
        try:
            seen = spark.read.parquet(f"{out}/marks").where(F.col("batch") < batch).agg(F.max("latest").alias("m")).first().m
        except AnalysisException:  # no batch before this one
            seen = None
        placed = rows.withColumn("_w", F.window(F.col(ts).cast("timestamp"), width))
        open_ = F.lit(True) if seen is None else F.col("_w.end") > F.lit(seen) - F.expr(f"interval {delay}")
        marked = placed.withColumn("_open", open_).persist()
        try:
            marked.where("_open").groupBy(F.col("_w.start").cast("timestamp_ntz").alias("since"), kind.alias("kind")).agg(
                F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{out}/counts/batch={batch}")
            behind = marked.where("NOT _open").select(*rows.columns).unionByName(rows.where(F.col(ts).isNull()))  # windows leave out nulls
            behind.write.mode("overwrite").parquet(f"{out}/late/batch={batch}")
            marked.agg(F.max(F.col(ts).cast("timestamp")).alias("latest")).write.mode("overwrite").parquet(f"{out}/marks/batch={batch}")
        finally:
            marked.unpersist()

    stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def counted(spark: SparkSession, out: str) -> DataFrame:
    """The counts that ``count_windows`` has landed: ``since, kind, rows``."""
    return spark.read.parquet(f"{out}/counts").groupBy("since", "kind").agg(F.sum("rows").alias("rows"))


# ---- verdicts on a running feed ---------------------------------------------------------

START = {"published": 0, "missing": -1, "island": 0, "since": 0, "told": 0, "last": -1, "quiet": 0, "timer": -1}  # the timer last


def advance(state: dict, rows: list[tuple[int, int, int]], graces: tuple[int, int, int]) -> list[tuple[str, int, int, int]]:
    """Take rows ``(microseconds, tie, missing)`` in order into a key's state; verdicts ``(kind, island, since, tie)``.

    A stretch of missing rows longer than its grace is told once: ``never published`` before any other row was seen,
    ``vanished`` afterwards. A gap longer than the third grace is told as ``silent``, with the time before it.
    """
    publish, vanish, silence = graces
    out = []
    for at, tie, missing in sorted(rows):
        out += quiet(state, at, silence)
        if missing != state["missing"]:
            state.update(island=state["island"] + 1, since=at, told=0)
        if not missing:
            state["published"] = 1
        elif not state["told"] and (at - state["since"]) // 1_000_000 > (vanish if state["published"] else publish):
            state["told"] = 1
            out.append(("vanished" if state["published"] else "never published", state["island"], state["since"], tie))
        state.update(missing=missing, last=at, quiet=0)
    return out


def quiet(state: dict, now: int, silence: int) -> list[tuple[str, int, int, int]]:
    """The verdict on a key without a row for more than ``silence`` seconds before ``now``, told once per gap."""
    if state["last"] < 0 or state["quiet"] or now - state["last"] <= silence * 1_000_000:
        return []
    state["quiet"] = 1
    return [("silent", state["island"], state["last"], -1)]


class Watch(StatefulProcessor):
    """State of one key: the stretch it is in, rows that wait for the watermark, and one event-time timer.

    Each call for state is a message between processes, so all of a key's state is one record, the waiting rows as JSON.
    """

    def __init__(self, by: str, graces: tuple[int, int, int]):
        self.by, self.graces = by, graces

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", ", ".join(f"{c} long" for c in START) + ", waiting string")

    def handleInputRows(self, key, rows, timerValues):
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        fresh = []
        for r in rows:
            if r.at is None or r.at < mark:
                yield Row(**{self.by: key[0]}, kind="late", island=-1, since_us=r.at, tie=r.tie)
            else:
                fresh.append((r.at, r.tie, r.missing))
        yield from self._told(key, mark, self.state.get(), fresh)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark, held = timerValues.getCurrentWatermarkInMs() * 1000, self.state.get()
        # Rows of the same batch have taken the key up to the watermark and set a timer behind it, or none.
        if held is not None and 0 <= held[len(START) - 1] * 1000 <= mark:
            yield from self._told(key, mark, held, [])

    def _told(self, key, mark, held, fresh):
        """Take what the watermark has passed, keep the rest, set the timer for whatever is due first."""
        state = dict(START) if held is None else dict(zip(START, held))
        waiting = fresh if held is None else [*map(tuple, json.loads(held[len(START)])), *fresh]
        due, rest = [r for r in waiting if r[0] < mark], [r for r in waiting if r[0] >= mark]
        found = advance(state, due, self.graces) + quiet(state, mark, self.graces[2])
        wake = [r[0] + 1 for r in rest]
        if state["last"] >= 0 and not state["quiet"]:
            wake.append(state["last"] + self.graces[2] * 1_000_000 + 1)
        timer = -(-min(wake) // 1000) if wake else -1
        if timer != state["timer"]:
            if state["timer"] * 1000 > mark:
                self.handle.deleteTimer(state["timer"])
            if timer >= 0:
                self.handle.registerTimer(timer)
            state["timer"] = timer
        self.state.update((*state.values(), json.dumps(rest)))
        for kind, island, since, tie in found:
            yield Row(**{self.by: key[0]}, kind=kind, island=island, since_us=since, tie=tie)

    def close(self) -> None:
        pass


def watch(stream: DataFrame, by: str, ts: str, tie: str, missing: Column, publish_grace: int, vanish_grace: int, silence: int, delay: str) -> DataFrame:
    """Verdicts on the keys of a running feed: ``by, kind, island, since_us, tie``, each as soon as the watermark allows.

    Rows of a key are taken in the order of ``ts`` and ``tie``, however they arrive within ``delay``, so verdicts are
    those of the batch rule (``windows.verdicts``) on the rows in time. ``silent`` comes from a timer where no row does.
    A row behind the watermark comes out as ``late`` with its time and tie. Graces and ``silence`` are seconds; a null
    ``missing`` counts as not missing. State per key is one record and the rows of the last ``delay``.
    """
    rows = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    # The arithmetic takes the watermark's mark off the column: it keeps its clock, but drops no row before this operator.
    at = F.unix_micros(F.col("_ts") + F.expr("interval 0 seconds"))
    plain = rows.select(by, at.alias("at"), F.col(tie).cast("long").alias("tie"), F.coalesce(missing.cast("long"), F.lit(0)).cast("long").alias("missing"))
    kind = stream.schema[by].dataType.simpleString()
    return plain.groupBy(by).transformWithState(
        Watch(by, (publish_grace, vanish_grace, silence)), f"{by} {kind}, kind string, island long, since_us long, tie long", "Append", "EventTime")
