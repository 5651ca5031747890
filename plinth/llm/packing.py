"""Sequences of fixed capacity from documents: shortest pack first over the histogram of lengths.

Documents longer than the capacity are cut into full pieces and a rest. Only the histogram of piece lengths, at most
one row per length, comes to the driver. Lengths are placed longest first; a packing pattern is a fill level shared by
``count`` sequences with consecutive numbers, and the emptiest pattern takes the next pieces. The outcome is a list of
slots, each a run of equal pieces that go to consecutive sequences at one offset; its size follows the number of
lengths and patterns, not the number of documents. Pieces find their slot by their rank among the pieces of their length.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plinth.llm.tokens import encoder

CAPACITY = 4096
BATCH_BYTES = 1 << 20


@dataclass
class Plan:
    """Slots in placing order: rank of their first piece, its sequence and the offset there."""

    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    first_rank: dict[int, int]  # of each length
    sequences: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Place ``histogram[length]`` pieces of every length, 1 to ``capacity``, into sequences."""
    patterns: list[tuple[int, int, int]] = []  # fill, first sequence, number of sequences
    slots: list[tuple[int, int, int]] = []
    first_rank, rank, sequences = {}, 0, 0
    for length in sorted(histogram, reverse=True):
        left, first_rank[length] = histogram[length], rank
        while left and patterns and patterns[0][0] + length <= capacity:
            fill, first, count = heapq.heappop(patterns)
            taken = min(left, count)
            slots.append((rank, first, fill))
            rank, left = rank + taken, left - taken
            if fill + length < capacity:
                heapq.heappush(patterns, (fill + length, first, taken))
            if taken < count:
                heapq.heappush(patterns, (fill, first + taken, count - taken))
        if left:  # nothing has room: new sequences, each filled before the next is begun
            each = capacity // length
            for rows, count in ((each, left // each), (left % each, 1)):
                if rows and count:
                    for j in range(rows):
                        slots.append((rank, sequences, j * length))
                        rank += count
                    if rows * length < capacity:
                        heapq.heappush(patterns, (rows * length, sequences, count))
                    sequences += count
    columns = np.array(slots, dtype=np.int64).reshape(-1, 3).T
    return Plan(columns[0], columns[1], columns[2], first_rank, sequences)


def _pieces(tokenizer: str, end_id: int, capacity: int):
    def run(batches):
        own = encoder(tokenizer)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = np.cumsum([len(t or "") for t in texts])
            edges = np.flatnonzero(np.diff(sizes // BATCH_BYTES, prepend=-1)).tolist() + [len(texts)]
            for lo, hi in zip(edges[:-1], edges[1:]):
                ids = own.encode(texts[lo:hi], end_id)
                total = np.array([len(x) // 4 for x in ids])
                count = -(-total // capacity)
                row = np.repeat(np.arange(hi - lo), count)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * capacity
                length = np.minimum(capacity, total[row] - start)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(lo, hi - lo).take(pa.array(row)),
                    "start": start, "length": length, "doc_tokens": total[row],
                    "ids": pa.array([ids[r][4 * s:4 * (s + n)] for r, s, n in zip(row, start, length)], type=pa.binary()),
                })

    return run


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Whole ``docs(doc_id, text)`` as pieces: ``doc_id, start, length, doc_tokens, ids``.

    Ids are little-endian unsigned 32-bit integers; ``end_id`` follows each document. Null text counts as empty, so it is
    one piece with ``end_id`` alone. ``tokenizer`` is the path of the tokenizer's file.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(
        _pieces(tokenizer, end_id, capacity), "doc_id long, start long, length long, doc_tokens long, ids binary"
    )


def pack(rows: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Give each row with a ``length`` in 1..capacity a ``sequence_id`` and a gapless ``offset`` there.

    ``order`` names columns that tell the rows of one length apart; rows that agree in all of them may swap places. Read
    twice, so give it a table. Other columns stay, but for ones named like the two results or ``_share, _own, _base, _slot``.
    """
    spark = rows.sparkSession
    rows = rows.drop("sequence_id", "offset", "_share", "_own", "_base", "_slot")
    histogram = {r.length: r["count"] for r in rows.groupBy("length").count().collect()}
    if any(not 1 <= n <= capacity for n in histogram):
        raise ValueError("lengths must be between 1 and the capacity")
    found = plan(histogram, capacity)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A rank within the length in two steps, so that a length that many rows have is not one task's.
    share = F.pmod(F.xxhash64(*order), F.lit(parts)).alias("_share")
    dealt = rows.select("*", share)
    counts = dealt.groupBy("length", "_share").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "_share", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    own = Window.partitionBy("length", "_share").orderBy(*order)
    ranked = dealt.withColumn("_own", F.row_number().over(own) - 1).join(bases, ["length", "_share"])
    plans = spark.sparkContext.broadcast(found)  # bounded by the number of lengths and patterns

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        p = plans.value
        rank = rank.to_numpy() + length.map(p.first_rank).to_numpy()
        at = np.searchsorted(p.rank, rank, side="right") - 1
        return pd.DataFrame({"sequence_id": p.sequence[at] + rank - p.rank[at], "offset": p.offset[at]})

    placed = ranked.withColumn("_slot", slot("length", F.col("_own") + F.col("_base")))
    return placed.select(*rows.columns, "_slot.*")
