"""Incremental writes, publishing and running feeds where things vanish, die half way or come late."""

import collections
import datetime
import random
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row
from pyspark.sql import functions as F

from plinth.catalog import REGISTRY, q_streams
from plinth.catalog.tables import Tables
from plinth.runtime import scratch
from plinth.sources import sinks as K
from plinth.streaming import feeds as R
from tests.conftest import SF_DIR
from tests.oracle import compare

SCHEMA = "id long, v double, part string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("step", range(4))
def test_write_changed_equals_a_full_rewrite(spark, step):
    """Random versions of a table with null and odd partition values, repeated rows and partitions that come and go."""
    rng = random.Random(step)
    path = scratch(spark, "table")
    values = ["a", "b c", "x=y/z%", None, "ü"]
    version = lambda: [(rng.randrange(9), rng.choice([1.0, 2.0, None]), rng.choice(values[:rng.randint(1, 5)])) for _ in range(rng.randint(1, 25))]
    for _ in range(4):
        new = spark.createDataFrame(version(), SCHEMA)
        K.write_changed(path, new, "part")
        assert rows_of(spark.read.schema(SCHEMA).parquet(path).select("id", "v", "part")) == rows_of(new)
    files = lambda: {r[0] for r in spark.read.schema(SCHEMA).parquet(path).select("_metadata.file_path").distinct().collect()}
    before = files()
    K.write_changed(path, new, "part")
    assert files() == before


def test_a_lost_removal_is_made_up_for(spark, monkeypatch):
    path = scratch(spark, "table")
    K.write_changed(path, spark.createDataFrame([(1, 1.0, "a"), (2, 1.0, "b"), (3, 1.0, "c")], SCHEMA), "part")
    new = spark.createDataFrame([(1, 2.0, "a"), (2, 1.0, "b")], SCHEMA)

    def die(*_args, **_kept):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(K, "remove", die)
        with pytest.raises(OSError):
            K.write_changed(path, new, "part")
    K.write_changed(path, new, "part")
    assert rows_of(spark.read.schema(SCHEMA).parquet(path).select("id", "v", "part")) == rows_of(new)


def test_publish_again_and_die_half_way(spark, monkeypatch):
    data, manifest = scratch(spark, "data"), scratch(spark, "manifest")
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "sample_id long")
    K.land(rows(7), data, "r0")
    assert K.published(spark, data, manifest).count() == 0
    K.publish(rows(1, 2, 3), data, manifest, "r1")
    K.publish(rows(9), data, manifest, "2024")  # a run whose name looks like a number

    def die(*_args):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(K, "name", die)
        with pytest.raises(OSError):
            K.publish(rows(4), data, manifest, "r1")
    shown = lambda: {(r.run, r.sample_id) for r in K.published(spark, data, manifest).collect()}
    assert shown() == {("r1", 1), ("r1", 2), ("r1", 3), ("2024", 9)}
    K.publish(rows(2, 5), data, manifest, "r1")
    assert shown() == {("r1", 2), ("r1", 5), ("2024", 9)}


def plain_verdicts(rows, graces):
    publish, vanish, silence = (g * 1_000_000 for g in graces)
    out, published, island, previous, since, told, last = [], False, 0, None, 0, False, None
    for at, tie, missing in sorted(rows):
        if last is not None and at - last > silence:
            out.append(("silent", island, last))
        if missing != previous:
            island, since, told, previous = island + 1, at, False, missing
        published = published or not missing
        if missing and not told and (at - since) // 1_000_000 > (vanish if published else publish) // 1_000_000:
            told = True
            out.append(("vanished" if published else "never published", island, since))
        last = at
    return out


@pytest.mark.parametrize("seed", range(5))
def test_advance_in_any_cuts(seed):
    """Rows of a key taken at once or in pieces, with the clock moving between, give the same verdicts."""
    rng = random.Random(seed)
    at, rows = 0, []
    for n in range(120):
        at += rng.choice([1, 20, 400, 5000]) * 1_000_000
        rows.append((at, n, int(rng.random() < 0.6 if n > 20 else True)))
    graces = (600, 900, 3000)
    for pieces in (1, 7, 60):
        state, found, lo = dict(R.START), [], 0
        while lo < len(rows):
            hi = min(len(rows), lo + rng.randint(1, 2 * len(rows) // pieces))
            found += R.advance(state, rows[lo:hi], graces)
            clock = rows[hi - 1][0] if hi == len(rows) else rng.randint(rows[hi - 1][0], rows[hi][0])
            found += R.quiet(state, clock, graces[2])
            lo = hi
        assert [f[:3] for f in found] == plain_verdicts(rows, graces)


EVENTS = "event_id long, ts timestamp, user_id long, kind string"


def files(spark, path, *batches):
    zero = datetime.datetime(2024, 1, 1)
    for rows in batches:
        table = [(i, None if m is None else zero + datetime.timedelta(minutes=m), u, k) for i, m, u, k in rows]
        spark.createDataFrame(table, EVENTS).coalesce(1).write.mode("append").parquet(path)


FEED = [
    [(1, 0, 1, "ok"), (2, 5, 2, "error"), (3, 12, 1, "error")],
    [(4, 9, 2, "error"), (5, 100, 2, "error"), (6, 95, 1, "error"), (7, None, 1, "ok")],  # 6 comes after 5 but within the delay
    [(8, 97, 2, "ok"), (9, 3, 1, "ok"), (10, 300, 2, "error")],  # 9 is behind the watermark
]


def test_watch_over_a_restart(spark):
    """Key 1 vanishes and falls silent, key 2 comes back and does too, rows come out of order and late; the stream stops after every file."""
    source, out, state = (scratch(spark, n) for n in ("feed", "out", "state"))
    before = spark.conf.get(R.STATE_STORE)
    spark.conf.set(R.STATE_STORE, R.ROCKS_DB)
    try:
        for batch in [*FEED, [(11, 9000, 3, "ok")]]:
            files(spark, source, batch)
            stream = R.folder(spark, source, EVENTS, 1)
            R.run_available(R.watch(stream, "user_id", "ts", "event_id", F.col("kind") == "error", 3600, 3600, 7200, "10 minutes"), out, state)
    finally:
        spark.conf.set(R.STATE_STORE, before)
    micro = lambda minute: (datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC) + datetime.timedelta(minutes=minute)).timestamp() * 1e6
    got = {(r.user_id, r.kind, r.island, r.since_us, r.tie) for r in spark.read.parquet(out).collect() if r.user_id != 3}
    assert got == {
        (1, "vanished", 2, micro(12), 6), (1, "silent", 2, micro(95), -1), (1, "late", -1, micro(3), 9), (1, "late", -1, None, 7),
        (2, "silent", 3, micro(100), -1), (2, "vanished", 3, micro(100), 10), (2, "silent", 3, micro(300), -1),
    }


def test_count_windows_keeps_late_rows_and_repeats_nothing(spark):
    source, out, state = (scratch(spark, n) for n in ("feed", "out", "state"))
    run = lambda: R.count_windows(R.folder(spark, source, EVENTS, 1), "ts", "30 minutes", F.col("kind"), "10 minutes", out, state)
    files(spark, source, *FEED)
    run()
    files(spark, source, [(11, 290, 2, "error"), (12, 20, 2, "ok")])
    run()
    run()
    late = {r.event_id for r in spark.read.parquet(f"{out}/late").collect()}
    assert late == {7, 9, 12}
    zero = datetime.datetime(2024, 1, 1)
    counts = {((r.since - zero).seconds // 60, r.kind): r.rows for r in R.counted(spark, out).collect()}
    assert counts == {(0, "ok"): 1, (0, "error"): 3, (90, "error"): 2, (90, "ok"): 1, (300, "error"): 1, (270, "error"): 1}


def test_a_replayed_batch_of_counts_changes_nothing(spark, monkeypatch):
    """The stream dies after landing a batch and before its commit; the batch runs again."""
    source, out, state = (scratch(spark, n) for n in ("feed", "out", "state"))
    run = lambda: R.count_windows(R.folder(spark, source, EVENTS, 1), "ts", "30 minutes", F.col("kind"), "10 minutes", out, state)
    files(spark, source, *FEED)
    run()
    before = rows_of(R.counted(spark, out)), rows_of(spark.read.parquet(f"{out}/late"))
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/commits/2")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, False)
    run()
    assert (rows_of(R.counted(spark, out)), rows_of(spark.read.parquet(f"{out}/late"))) == before


def test_nothing_published_without_data(spark):
    with pytest.raises(AnalysisException):
        K.published(spark, scratch(spark, "none"), scratch(spark, "none"))


def test_late_feed_is_split_and_says_the_same(spark, duck, monkeypatch):
    """Several files a write, each write one micro-batch."""
    monkeypatch.setattr(q_streams, "FILE_ROWS", 50)
    path, files = q_streams.late_feed(Tables(spark, SF_DIR))
    assert files > 1 and len(list(Path(path).glob("*.parquet"))) == 4 * files + 1
    query = REGISTRY["r4_progress_counts"]
    verdict, note, _, _ = compare(spark, duck, query, SF_DIR)
    assert verdict == "ok", note


def test_a_key_is_taken_once_a_batch():
    """a timer behind rows of the same batch read and wrote a key's state and waiting rows a second time."""
    calls = collections.Counter()

    class Handle:
        held, timers = None, set()

        def getValueState(self, name, schema):
            return self

        def get(self):
            calls["get"] += 1
            return self.held

        def update(self, value):
            calls["update"] += 1
            self.held = value

        def registerTimer(self, at):
            self.timers.add(at)

        def deleteTimer(self, at):
            self.timers.discard(at)

    class Values:
        mark = 0

        def getCurrentWatermarkInMs(self):
            return self.mark

    handle, values, told = Handle(), Values(), []
    watch = R.Watch("k", (5, 5, 100))
    watch.init(handle)
    row = lambda at, tie, missing: Row(at=at * 1_000_000, tie=tie, missing=missing)
    told += watch.handleInputRows((1,), iter([row(9, 2, 1), row(1, None, 1)]), values)
    values.mark = 20_000
    told += watch.handleInputRows((1,), iter([row(30, 3, 0)]), values)
    assert calls == {"get": 2, "update": 2} and len(told) == 1
    for fired in sorted(t for t in handle.timers if t <= values.mark):
        told += watch.handleExpiredTimer((1,), values, fired)
    assert calls["update"] == 2  # the rows of this batch have done it
    values.mark = 200_000
    told += watch.handleExpiredTimer((1,), values, max(handle.timers))
    assert [(r.kind, r.since_us) for r in told] == [("never published", 1_000_000), ("silent", 30_000_000)]
