"""Exact top-k by exhaustive term-at-a-time accumulation.

Rows are sparse: a term is a position of the weight array, a missing or zero weight has no posting. Rows are dealt into
blocks of about ``ROWS`` and queries into blocks of about ``QUERIES``. Every query block meets every row block once: the
query's terms are taken one at a time, and each adds its weight times the posting list's weights to a dense array of
scores, one cell per row of the block. The k best of a block are selected by partitioning, and the blocks' selections are
merged. No score is skipped, and a block pair is all that a task holds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plinth.runtime import large

ROWS, QUERIES = 1 << 13, 1 << 10


class Block:
    """Ids of some rows and their postings: per term the rows that have it and their weights."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray, weights: np.ndarray):
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order]
        lengths = np.diff(offsets)
        place = np.empty(len(ids), dtype=np.int64)
        place[self.order] = np.arange(len(ids))
        row = np.repeat(place, lengths)
        term = np.arange(len(weights)) - np.repeat(offsets[:-1], lengths)
        there = weights != 0
        self.row, self.term, self.weight = row[there], term[there], weights[there]

    def postings(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        order = np.lexsort((self.row, self.term))
        edges = np.flatnonzero(np.diff(self.term[order], prepend=-1, append=-1))
        return {int(self.term[order[a]]): (self.row[order[a:b]], self.weight[order[a:b]]) for a, b in zip(edges[:-1], edges[1:])}

    def queries(self):
        order = np.lexsort((self.term, self.row))
        edges = np.searchsorted(self.row[order], np.arange(len(self.ids) + 1))
        for i, key in enumerate(self.ids.tolist()):
            own = order[edges[i]:edges[i + 1]]
            yield key, self.term[own].tolist(), self.weight[own].tolist()


def _block(ids: pa.ListScalar, weights: pa.ListScalar) -> Block:
    ids, weights = ids.values, weights.values
    return Block(ids.to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(weights.value_lengths().to_numpy())]),
                 weights.flatten().to_numpy(zero_copy_only=False))


def _scored(k: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows = _block(batch.column("row_ids")[i], batch.column("row_weights")[i])
                postings = rows.postings()
                out = {"query_id": [], "vec_id": [], "score": []}
                for key, terms, weights in _block(batch.column("query_ids")[i], batch.column("query_weights")[i]).queries():
                    scores = np.zeros(len(rows.ids), dtype=np.int64)
                    for term, weight in zip(terms, weights):
                        if term in postings:
                            at, held = postings[term]
                            scores[at] += weight * held
                    other = np.flatnonzero(rows.ids != key)
                    own = scores[other]
                    if len(own) > k:  # all ties of the k-th score stay, so that the smaller ids win
                        least = np.partition(own, len(own) - k)[len(own) - k]
                        other, own = other[own >= least], own[own >= least]
                        if len(own) > k:
                            best = np.lexsort((rows.ids[other], -own))[:k]
                            other, own = other[best], own[best]
                    out["query_id"].append(np.full(len(own), key))
                    out["vec_id"].append(rows.ids[other])
                    out["score"].append(own)
                if out["score"]:
                    yield pa.RecordBatch.from_pydict({c: np.concatenate(v) for c, v in out.items()})

    return run


def exact_top(rows: DataFrame, queries: DataFrame, k: int, row_block: int = ROWS, query_block: int = QUERIES) -> DataFrame:
    """The ``k`` rows with the largest inner product for each query: ``query_id, rank, vec_id, score``.

    Both inputs hold ``id long, weights array<long>`` with non-null ids, unique among the queries. Rows that share an id
    are candidates each for itself; rows with the query's own id are none. An empty array scores 0 with everything. Ties go to the smaller id. Weights are integers, and so are scores (64 bits). Arrays may differ in length.
    """
    n, m = rows.count(), queries.count()
    blocks = max(1, -(-n // row_block))
    of = lambda count: F.pmod(F.xxhash64("id"), F.lit(count))

    def packed(table: DataFrame, count: int, name: str) -> DataFrame:
        return table.groupBy(of(count).alias(f"{name}_block")).agg(F.collect_list(F.struct("id", "weights")).alias("x")).select(
            f"{name}_block", F.col("x.id").alias(f"{name}_ids"), F.col("x.weights").alias(f"{name}_weights")
        )

    asked = packed(queries, max(1, -(-m // query_block)), "query").withColumn(
        "row_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))
    )
    # Few queries look small to the planner, but there is a copy of them per row block: they never pass through the driver.
    pairs = packed(rows, blocks, "row").join(large(asked), "row_block").select("row_ids", "row_weights", "query_ids", "query_weights")
    found = pairs.mapInArrow(_scored(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
