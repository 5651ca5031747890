"""Centroid clustering of integer vectors by scalar lookup tables.

Every round tabulates, for each dimension, the squared difference of each integer value that occurs to each centroid; a
vector's distances are then gathers from the tables and sums, without a multiplication per vector. Tables cover the values
of one slice of ``ROWS`` vectors, so their size is bounded however far values spread.

A round is one pass: tasks sum their vectors per cluster, Spark adds those sums, and only the centroids (clusters times
dimensions integers) pass through the driver. All arithmetic is in integers, so the order of vectors changes nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.runtime import cut

ROWS = 1 << 13
LARGEST = 1 << 26  # of a component; keeps distances within 64 bits below 512 dimensions


def whole_vectors(vectors: DataFrame, key: str, column: str, size: int, factor: int) -> DataFrame:
    """``id, vector array<bigint>``: ``floor(factor * x)`` of vectors with ``size`` components, all of them finite.

    Other rows (null, another size, a null or non-finite component) are left out; repeated or null ids are kept.
    """

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("vector"))
    fine = rows.where((F.size("vector") == size) & F.forall("vector", finite))
    return fine.select("id", F.transform("vector", lambda x: F.floor(x * factor).cast("bigint")).alias("vector"))


def first_centroids(rows: DataFrame, count: int, seed: int) -> list[list[int]]:
    """The ``count`` vectors with the smallest digests of ``seed:id``; ties (equal ids) by vector, a null id is empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    return [r.vector for r in rows.select("vector", digest.alias("h")).orderBy("h", "vector").limit(count).collect()]


def nearest(values: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and squared distance for each row of ``values``."""
    total = np.zeros((len(values), len(centroids)), dtype=np.int64)
    for d in range(values.shape[1]):
        seen, code = np.unique(values[:, d], return_inverse=True)
        table = (seen[:, None] - centroids[None, :, d]) ** 2
        total += table[code]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(values)), best]


def _slices(batches, size: int):
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            part = batch.slice(lo, ROWS)
            values = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            if np.abs(values).max(initial=0) > LARGEST or values.min(initial=0) == np.iinfo(np.int64).min:
                raise ValueError(f"a component is beyond {LARGEST}: squared distances could leave 64 bits")
            yield part, values


def _sums(centroids: np.ndarray):
    def run(batches):
        count = np.zeros(len(centroids), dtype=np.int64)
        sums = np.zeros_like(centroids)
        for _, values in _slices(batches, centroids.shape[1]):
            cluster, _ = nearest(values, centroids)
            order = np.argsort(cluster, kind="stable")
            met, first = np.unique(cluster[order], return_index=True)
            sums[met] += np.add.reduceat(values[order], first, axis=0)
            count += np.bincount(cluster, minlength=len(centroids))
        there = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(there, pa.int32()), "n": pa.array(count[there], pa.int64()),
            "sums": pa.array(list(sums[there]), pa.list_(pa.int64())),
        })

    return run


def _assigned(centroids: np.ndarray):
    def run(batches):
        for part, values in _slices(batches, centroids.shape[1]):
            cluster, distance = nearest(values, centroids)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"]
            )

    return run


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid's ``floor(sum / count)`` over the vectors nearest to it; one without vectors stays."""
    parts = rows.mapInArrow(_sums(centroids), "cluster int, n long, sums array<long>")
    wide = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(centroids.shape[1])]
    after = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *wide).collect():
        after[row.cluster] = [int(row[f"s{d}"]) // row.n for d in range(centroids.shape[1])]
    return after


def clusters(rows: DataFrame, centroids: list[list[int]], rounds: int) -> DataFrame:
    """``rows(id, vector array<bigint>)`` -> one row per row: ``id, cluster, distance, cluster_inertia, inertia, centroid``.

    ``centroids`` start the search, ``rounds`` move them, then vectors are assigned once more. Distances are squared and
    Euclidean, ties go to the smaller number. All vectors have as many components as the centroids. Components beyond
    ``LARGEST`` are an error, as are sums of distances that leave 64 bits. Without centroids the result is empty.
    """
    spark = rows.sparkSession
    schema = "id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<bigint>"
    if not centroids:
        return spark.createDataFrame([], schema)
    held = np.array(centroids, dtype=np.int64)
    for _ in range(rounds):
        held, before = moved(rows, held), held
        if (held == before).all():
            break
    found = cut(rows.mapInArrow(_assigned(held), "id long, cluster int, distance long"))
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole = sum(sums.values())
    about = spark.createDataFrame(
        [(k, s, whole, held[k].tolist()) for k, s in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid array<bigint>"
    )
    # One row per centroid at most, whose number the caller gave.
    return found.join(F.broadcast(about), "cluster").select(*[c.split()[0] for c in schema.split(", ")])
