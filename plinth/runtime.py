"""Session-level helpers: reliable lineage cuts and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset and all tasks run on this
    machine (tests) is a temporary folder created and remembered in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Lets Spark delete the shuffle files of a finished write at once; without it they stay until the driver's garbage goes.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    A lost executor then never replays the lineage. Reading a table also starts from a clean plan:
    a checkpointed frame carries its inferred constraints along, and in a loop those grow until
    planning takes longer than the work. ``discard`` removes the table again.
    """
    spark = df.sparkSession
    path = scratch(spark, "cut")
    before = spark.conf.get(TIDY, "false")
    spark.conf.set(TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(TIDY, before)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.cut_path = path
    return kept


def discard(*frames: DataFrame) -> None:
    """Remove the tables behind frames that came straight from ``cut`` and that no later step reads."""
    for frame in frames:
        remove(frame.sparkSession, frame.cut_path)


def remove(spark: SparkSession, path: str, encoded: bool = False) -> None:
    """Delete a folder through the file system that Spark uses for it; ``encoded`` paths are those of ``_metadata``."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(path) if encoded else path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def large(df: DataFrame) -> DataFrame:
    """A side of a join that is never broadcast.

    The planner guesses sizes from files: compressed columns, and rows before they unfold, look far smaller than what the
    driver would have to hold.
    """
    return df.hint("merge")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Even out rows whose processing is far heavier than their size before they unfold.

    The explicit count keeps adaptive execution from packing such rows back together by bytes.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
