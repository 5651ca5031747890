"""Streaming queries (R) and the multi-round fill (M2)."""

from __future__ import annotations

import datetime
import hashlib
import json

from pyspark.sql import functions as F

from plinth.catalog.q_windows import SETTINGS
from plinth.catalog.q_aggregates import _SHARES
from plinth.catalog.registry import query
from plinth.plans.fill import fill
from plinth.runtime import scratch
from plinth.streaming import feeds as R

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def feed_folder(t, parts=4, close=True):
    """The events as several files, plus one far later row that lets every window close."""
    path = scratch(t.spark, "feed")
    rows = t.events
    if close:
        last = rows.groupBy(F.lit(-1).cast("long").alias("event_id")).agg((F.max("ts") + F.expr("interval 10 days")).alias("ts")).select(
            "event_id", "ts", F.lit(-1).cast("long").alias("user_id"), F.lit("end").alias("event_type"), F.lit(0.0).alias("value"), F.lit("{}").alias("props"))
        rows = rows.unionByName(last)
    rows.repartitionByRange(parts, "ts").write.parquet(path)
    return path


HELD_BACK, AGAIN = 50, 40  # one row in so many comes after all others; one in so many comes twice
FILE_ROWS = 50_000


def late_feed(t, parts=3):
    """The events in the order of time, then rows that were held back or come again, then a far later row.

    Comes with the number of files that each of these writes has, so that a micro-batch of as many files is one write and
    no task reads or writes a whole one.
    """
    path = scratch(t.spark, "feed")
    rows = t.events.cache()
    held = F.col("event_id") % HELD_BACK == 7
    cuts = rows.where(~held).agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count(F.lit(1)).alias("n")).first()
    files = max(1, cuts.n // parts // FILE_ROWS)  # few against the rows of any write, so that none stays empty
    for k in range(parts):
        low, high = (cuts.a + (cuts.b - cuts.a) * n / parts for n in (k, k + 1))
        inside = (F.col("ts") >= F.lit(low)) & ((F.col("ts") < F.lit(high)) | F.lit(k + 1 == parts))
        rows.where(~held & inside).repartition(files).write.mode("append").parquet(path)
    rows.where(held).unionByName(rows.where(F.col("event_id") % AGAIN == 3)).repartition(files).write.mode("append").parquet(path)
    end = t.spark.createDataFrame([(-1, cuts.b + datetime.timedelta(days=10), -1, "end", 0.0, "{}")], SCHEMA)
    end.coalesce(1).write.mode("append").parquet(path)
    rows.unpersist()
    return path, files


_LATE_MARK = f"(SELECT epoch_ms(max(ts)) - 60000 FROM events WHERE event_id % {HELD_BACK} <> 7)"


@query("r1_fill_gaps", "SELECT event_id, event_type = 'error' AS junk FROM events")
def _(t):
    source, out, state = feed_folder(t, close=False), scratch(t.spark, "tagged"), scratch(t.spark, "state")
    tag = lambda rows: rows.select("event_id", (F.col("event_type") == "error").alias("junk"))
    for _run in range(2):  # the second run finds nothing new
        R.fill_gaps(R.folder(t.spark, source, SCHEMA, 2), tag, out, state)
    return t.spark.read.parquet(out).select("event_id", "junk")


@query("r2_accept_once", "SELECT DISTINCT user_id, event_type FROM events")
def _(t):
    source, out, state = feed_folder(t, close=False), scratch(t.spark, "accepted"), scratch(t.spark, "state")
    stream = R.folder(t.spark, source, SCHEMA, 2)
    R.run_available(R.accept_once(stream, ["user_id", "event_type"]).select("user_id", "event_type"), out, state)
    return t.spark.read.parquet(out)


@query("r3_sessions", """
    WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS n FROM events),
      b AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM a)
    SELECT user_id, epoch_us(min(ts)) AS since_us, epoch_us(max(ts)) + 7200000000 AS until_us, count(*) AS rows FROM b GROUP BY user_id, s""")
def _(t):
    source, out, state = feed_folder(t), scratch(t.spark, "sessions"), scratch(t.spark, "state")
    R.run_available(R.sessions(R.folder(t.spark, source, SCHEMA), "user_id", "ts", "2 hours", "1 minute"), out, state)
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    us = lambda c: F.timestamp_diff("MICROSECOND", zero, F.col(c)).alias(f"{c}_us")
    return t.spark.read.parquet(out).where("user_id >= 0").select("user_id", us("since"), us("until"), "rows")


_GRACES = 3600, 7200, 14400


@query("r3_feed_verdicts", f"""
    WITH f AS (SELECT user_id, ts, event_id, event_type = 'error' AS missing, event_id % {HELD_BACK} = 7 AND epoch_us(ts) < {_LATE_MARK} * 1000 AS late FROM events),
      a AS (SELECT *, max((NOT missing)::INTEGER) OVER w AS published, lead(ts) OVER w AS after, CASE WHEN missing IS NOT DISTINCT FROM lag(missing) OVER w THEN 0 ELSE 1 END AS chg
            FROM f WHERE NOT late WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
      b AS (SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM a),
      c AS (SELECT user_id, island, max(published) AS published, epoch_us(min(ts)) AS since_us, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS seconds
            FROM b WHERE missing GROUP BY user_id, island)
    SELECT user_id, CASE WHEN published = 1 THEN 'vanished' ELSE 'never published' END AS kind, island::BIGINT AS island, since_us FROM c
      WHERE seconds > CASE WHEN published = 1 THEN {_GRACES[1]} ELSE {_GRACES[0]} END
    UNION ALL SELECT user_id, 'silent', island::BIGINT, epoch_us(ts) FROM b WHERE after IS NULL OR epoch_us(after) - epoch_us(ts) > {_GRACES[2] * 1000000}::BIGINT
    UNION ALL SELECT user_id, 'late', -1, epoch_us(ts) FROM f WHERE late""")
def _(t):
    (source, files), out, state = late_feed(t), scratch(t.spark, "verdicts"), scratch(t.spark, "state")
    before = t.spark.conf.get(R.STATE_STORE)
    t.spark.conf.set(R.STATE_STORE, R.ROCKS_DB)
    try:
        stream = R.accept_once(R.folder(t.spark, source, SCHEMA, files), ["event_id"])
        R.run_available(R.watch(stream, "user_id", "ts", "event_id", F.col("event_type") == "error", *_GRACES, "1 minute"), out, state)
    finally:
        t.spark.conf.set(R.STATE_STORE, before)
    return t.spark.read.parquet(out).where("user_id >= 0").select("user_id", "kind", "island", "since_us")


@query("r4_progress_counts", f"""
    WITH f AS (SELECT *, event_id % {HELD_BACK} = 7 AND epoch_ms(date_trunc('hour', ts) + INTERVAL 1 HOUR) <= {_LATE_MARK} AS late FROM events)
    SELECT epoch_us(date_trunc('hour', ts)) AS since_us, event_type AS kind, count(*) AS rows, late FROM f GROUP BY ALL""")
def _(t):
    (source, files), out, state = late_feed(t), scratch(t.spark, "progress"), scratch(t.spark, "state")
    stream = R.accept_once(R.folder(t.spark, source, SCHEMA, files), ["event_id"])
    for _run in range(2):  # the second run finds nothing new
        R.count_windows(stream, "ts", "1 hour", F.col("event_type"), "1 minute", out, state)
    late = t.spark.read.parquet(f"{out}/late").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("since"), F.col("event_type").alias("kind")).agg(
        F.count(F.lit(1)).alias("rows"))
    both = R.counted(t.spark, out).withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return both.where("kind <> 'end'").select(F.timestamp_diff("MICROSECOND", zero, F.col("since")).alias("since_us"), "kind", "rows", "late")


def compose(prompts: list[str]) -> tuple[list[str | None], float]:
    """Deterministic stand-in for a scene model: reads the prompt, answers with offered assets.

    Some answers are deliberately unusable, so that later rounds have something to fill.
    """
    out = []
    for prompt in prompts:
        blocks = prompt.split("\n\n")
        uids = lambda block: [line[2:34] for line in block.split("\n") if line.startswith("- ")]
        relations = [line.split(". ", 1)[1].split(" — ")[0] for line in blocks[1].split("\n")[1:]]
        anchors = uids(next(b for b in blocks if b.startswith("Anchors on offer")))
        placed = uids(next(b for b in blocks if b.startswith("Objects to place")))
        samples = []
        for i, relation in enumerate(relations):
            a, b = anchors[i % len(anchors)], placed[(i * 7) % len(placed)]
            mark = int(hashlib.md5(f"{a}{b}{relation}".encode()).hexdigest()[:2], 16)
            anchor, thing = f"stand {a[:6]}", f"item {b[:6]}"
            if mark % 9 == 0:
                thing = f"shiny {thing}"
            verb = "jammed into" if mark % 11 == 0 else relation
            samples.append({
                "anchor_uid": "nobody" if mark % 13 == 0 else a, "anchor_name": anchor, "anchor_description": "a plain stand",
                "placed_uid": b, "placed_name": thing, "placed_description": "a plain item", "placement": f"{thing} {verb} the {anchor}",
            })
        out.append(json.dumps({"samples": samples}))
    return out, 0.004


@query("m2_multi_round_fill", f"""
    SELECT category, complexity, (CASE complexity WHEN 'simple' THEN ceil(q / 2) ELSE floor(q / 2) END)::BIGINT AS scenes, true AS distinct_keys FROM (
      SELECT category, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, ord) <= total - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS q
      FROM ({_SHARES.replace("FROM orders", "FROM labels")})), (VALUES ('simple'), ('complex')) k(complexity)
    WHERE category IN (SELECT category FROM members WHERE role = 'placed')""")
def _(t):
    total = t.labels.count()
    scenes = fill(t.pool, total, SETTINGS, compose, "fill")
    return scenes.groupBy("category", "complexity").agg(
        F.count(F.lit(1)).alias("scenes"), ((F.countDistinct("k1") == F.count(F.lit(1))) & (F.countDistinct("k2") == F.count(F.lit(1)))).alias("distinct_keys"))
