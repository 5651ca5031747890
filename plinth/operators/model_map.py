"""Batched calls of a user function over prompts, with retries; failures never fail the job."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Reply = tuple[list[str | None], float]


def model_map(df: DataFrame, key: str, prompt: str, call: Callable[[list[str]], Reply],
              batch: int = 40, attempts: int = 3) -> DataFrame:
    """``call`` on every ``batch`` prompts: rows ``(key, reply, error, calls, cost)``.

    ``call`` takes a list of prompts and returns one reply (JSON text or None) per prompt and the
    cost. Batches are cut from the partition as it streams, so nothing is shuffled. A batch that
    keeps raising leaves its rows with an error; a reply left out leaves its row pending. Calls
    and cost sit on the first row of each batch.
    """
    key_type = df.schema[key].dataType.simpleString()

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        error, replies, cost, calls = None, [None] * len(rows), 0.0, 0
        for _ in range(attempts):
            try:
                replies, cost = call(list(rows["_prompt"]))
                calls, error = 1, None
                break
            except Exception as failure:  # noqa: BLE001 - the row carries the reason
                error = f"{type(failure).__name__}: {failure}"
        first = [1 if n == 0 else 0 for n in range(len(rows))]
        return pd.DataFrame({
            key: rows[key], "reply": (list(replies) + [None] * len(rows))[: len(rows)], "error": error,
            "calls": [calls * f for f in first], "cost": [cost * f for f in first],
        })

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            full = len(held) // batch * batch
            for start in range(0, full, batch):
                yield answer(held.iloc[start:start + batch])
            held = held.iloc[full:].reset_index(drop=True)
        if held is not None and len(held):
            yield answer(held)

    return df.select(key, F.col(prompt).alias("_prompt")).mapInPandas(
        run, f"{key} {key_type}, reply string, error string, calls int, cost double"
    )


def parsed(replies: DataFrame, schema: str) -> DataFrame:
    """Replies against a schema whose top-level fields are all required.

    ``data`` is null where the reply is missing, is not JSON or lacks a field.
    """
    data = F.from_json("reply", schema)
    fields = StructType.fromDDL(schema).fieldNames()
    complete = reduce(lambda a, b: a & b, [data[name].isNotNull() for name in fields])
    return replies.withColumn("data", F.when(complete, data))


def split_done(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(done, pending)`` rows of parsed replies."""
    return replies.where(F.col("data").isNotNull()), replies.where(F.col("data").isNull())


def spend(replies: DataFrame) -> DataFrame:
    """Calls, cost and cost per call (null without calls)."""
    total = replies.agg(F.sum("calls").cast("long").alias("calls"), F.sum("cost").alias("cost"))
    return total.withColumn("per_call", F.col("cost") / F.nullif("calls", F.lit(0)))
