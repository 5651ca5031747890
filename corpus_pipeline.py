"""A training corpus from ``documents``: toxic documents out, one of each group of near copies, repeats out, packed.

Stages take and return the columns of ``documents``; the last one returns pieces with their place in the sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.near_dups import Threshold, near_duplicates
from plinth.llm.packing import pack, pieces
from plinth.llm.substrings import without_repeats
from plinth.llm.toxicity import fit, scored
from plinth.runtime import cut

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER, END_ID = "word_bpe_49k.json", 2
ORACLE_SQL = None  # fitted scores and a tokenizer are beyond SQL; tests compare with brute force


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, fitted to ``labels``, doesn't predict toxic. Null texts stay."""
    lexicon = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs.select(*COLUMNS), lexicon).where("predicted = 0").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each class of near copies (five words, 0.8). Null doc_ids stay."""
    gone = near_duplicates(docs, Threshold(80, 100)).where("NOT kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 13-word windows that a document before them holds; emptied ones stay, empty, and
    those that lose nothing stay as they are."""
    marked = docs.withColumn("_null", F.col("text").isNull())
    kept = without_repeats(marked, carry=("lang", "source", "n_chars", "_null"), as_is=True)
    whole = F.col("n_removed") == 0
    return kept.select(
        "doc_id", F.when(~(whole & F.col("_null")), F.col("kept")).alias("text"), "lang", "source",
        F.when(whole, F.col("n_chars")).otherwise(F.length("kept")).cast("long").alias("n_chars"),
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    found = pieces(docs, public_tokenizers.path(TOKENIZER), END_ID)
    return pack(cut(found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")), ["doc_id", "start", "ids_crc32"])


STAGES = [
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_copies), ("substring_dedup", drop_repeats), ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
