"""Writers: append logs, write-if-changed, publish with a manifest, discard, export.

Every write names its batch, and a batch owns one folder that is overwritten. So a batch that is
written again after a crash, by a rerun or by a second attempt, counts once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.runtime import cut, remove
from plinth.runtime import discard as discard_table


def append(df: DataFrame, path: str, batch: str, partition: list[str] | None = None) -> None:
    """Add one batch to a table; writing the same batch again replaces it.

    Rows are clustered by the partition columns first, so that a partition isn't cut into a file per task.
    """
    rows = df.repartition(*partition) if partition else df
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*partition) if partition else writer).parquet(f"{path}/batch={batch}")


def changed(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """New rows that differ from the old row of the same key, or have none."""
    before = old.select(F.col(key).alias("_k"), F.struct(*fields).alias("_old"))
    joined = new.join(before, F.col(key) == F.col("_k"), "left")
    same = F.struct(*[F.col(f) for f in fields]).eqNullSafe(F.col("_old"))
    return joined.where(~same | F.col("_k").isNull()).drop("_k", "_old")


def touched(old: DataFrame, new: DataFrame, partition: str) -> DataFrame:
    """Values of ``partition`` whose rows differ between two versions of a table, each with ``gone``: ``new`` has none there.

    Rows count as often as they occur and nulls as equal, so altered, added, removed, repeated and moved rows all show;
    a row that moves shows in the partition it leaves too.
    """
    signed = old.select(*new.columns, F.lit(1).alias("_n")).unionByName(new.withColumn("_n", F.lit(-1)))
    differing = signed.groupBy(*new.columns).agg(F.sum("_n").alias("_n"), F.max(F.col("_n") < 0).alias("_new"))
    return differing.groupBy(partition).agg(F.max(F.col("_n") != 0).alias("_differs"), (~F.max("_new")).alias("gone")).where("_differs").drop("_differs")


def write_changed(path: str, new: DataFrame, partition: str) -> None:
    """Bring the table at ``path``, partitioned by ``partition``, to ``new``; without a table there, write all of it.

    Only partitions that differ are rewritten, each whole, and those without a row in ``new`` are removed after that. A
    write that is lost half way is repeated: what differs then is found again, and nothing else is touched. ``new`` must
    not read the table.
    """
    spark = new.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    writer = lambda rows: rows.repartition(F.col(partition)).write.partitionBy(partition)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        writer(new).parquet(path)
        return
    table = lambda: spark.read.schema(new.schema).parquet(path)
    differing = cut(touched(table(), new, partition))
    same = F.col("_p").eqNullSafe(F.col(partition))
    rewritten = differing.where("NOT gone").select(F.col(partition).alias("_p"))
    writer(new.join(rewritten, same, "left_semi")).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    emptied = differing.where("gone").select(F.col(partition).alias("_p"))
    # One row per partition that goes as a whole.
    files = table().withColumn("_file", F.col("_metadata.file_path")).join(emptied, same, "left_semi")
    for row in files.select(F.regexp_replace("_file", "/[^/]*$", "").alias("folder")).distinct().collect():
        remove(spark, row.folder, encoded=True)
    discard_table(differing)


def land(df: DataFrame, data: str, run: str) -> str:
    """Write the rows of one attempt to publish ``run`` and return its id; they do not count until ``name`` is called."""
    attempt = uuid.uuid4().hex
    df.write.parquet(f"{data}/run={run}/attempt={attempt}")
    return attempt


def name(spark: SparkSession, manifest: str, run: str, attempt: str) -> None:
    """Make an attempt the published one of its run: one row is added to the manifest, with a number beyond all before it."""
    before = _manifest(spark, manifest)
    last = before.where(F.col("run") == run).agg(F.max("number")).first()[0] if before is not None else None
    row = spark.createDataFrame([(run, attempt, (last or 0) + 1)], MANIFEST)
    row.coalesce(1).write.mode("append").parquet(manifest)


MANIFEST = "run string, attempt string, number long"


def _manifest(spark: SparkSession, manifest: str) -> DataFrame | None:
    place = spark._jvm.org.apache.hadoop.fs.Path(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest) if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place) else None


def published(spark: SparkSession, data: str, manifest: str) -> DataFrame:
    """Published rows with their ``run``: those of the attempt that the manifest named last for it, whatever else was written.

    Runs and attempts are folders, so only named ones are read. Before anything is named there are no rows.
    """
    rows = spark.read.option("basePath", data).parquet(data).withColumn("run", F.col("run").cast("string"))
    named = _manifest(spark, manifest)
    if named is None:
        return rows.limit(0).drop("attempt")
    newest = named.groupBy("run").agg(F.max(F.struct("number", "attempt")).alias("n")).select("run", "n.attempt")
    return rows.join(newest, ["run", "attempt"], "left_semi").drop("attempt")


def publish(df: DataFrame, data: str, manifest: str, run: str) -> None:
    """Write rows under an attempt of their own first and name the attempt last.

    Publishing a run again replaces its rows in one step: until the new attempt is named, the old one stays published, and
    a crash at any point leaves the one or the other. Rows of attempts that were never named can be deleted at any time.
    """
    name(df.sparkSession, manifest, run, land(df, data, run))


def pending(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return df.join(done.select(key), key, "left_anti")


def discard(df: DataFrame, doomed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(kept, tombstones)``: a key with any doomed row goes as a whole."""
    keys = doomed.select(key).distinct()
    return df.join(keys, key, "left_anti"), keys


def discard_version(root: str, df: DataFrame, doomed: DataFrame, key: str, version: int) -> None:
    """Write version ``version`` of a table without the doomed keys, and the keys as its tombstones.

    Earlier versions stay readable. The tombstones are written last: a version without them is not complete.
    """
    kept, keys = discard(df, doomed, key)
    kept.write.mode("overwrite").parquet(f"{root}/rows/version={version}")
    keys.write.mode("overwrite").parquet(f"{root}/tombstones/version={version}")


def payload(columns: list[str]) -> Column:
    """One self-contained JSON record."""
    return F.to_json(F.struct(*columns))
