"""Token ids in binary files: one zstandard frame per document, a dictionary that all files share, and an offset index.

A folder holds ``dictionary.bin`` (trained on serialized ids, possibly empty), ``shards/*.tok`` and ``manifest`` (a
table: one row per shard that counts, in doc_id order). A shard is::

    8 bytes   "TOKIDS01"
    32 bytes  sha256 of the dictionary
    8 bytes   bytes per id (2 or 4)
    frames    one per document, each compressed on its own
    index     n x (doc_id or 0, 1 if doc_id is null, number of ids, position of the frame), 64-bit integers
    24 bytes  n, position of the index, "TOKIDSIX"

so one document is read with two small reads and one frame. All integers are little-endian.

A task writes its shard under a name of its own and reports it in the manifest. A task that runs again after a lost
executor writes another file; what the manifest doesn't name doesn't count.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plinth.llm.tokens import encoder
from plinth.runtime import cut, discard

MAGIC, TAIL = b"TOKIDS01", b"TOKIDSIX"
SAMPLE_DOCUMENTS = 1_000  # at most so many train the dictionary, chosen by a hash of doc_id
SAMPLE_CHARS = 8_192  # longer documents aren't sampled; a dictionary serves short ones
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
BATCH_BYTES = 1 << 20


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri.removeprefix("file:"))


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary for serialized ids; empty if the samples are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _settings(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


class Shard:
    """Random access to the documents of one shard."""

    def __init__(self, uri: str, dictionary: bytes):
        system, path = _open(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        head = self.file.read_at(48, 0)
        count, self.index_at = (int(x) for x in np.frombuffer(self.file.read_at(16, size - 24), "<i8"))
        if head[:8] != MAGIC or self.file.read_at(8, size - 8) != TAIL:
            raise ValueError(f"{uri} is no token file")
        if head[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri} was written with another dictionary")
        self.kind = {2: "<u2", 4: "<u4"}[int.from_bytes(head[40:48], "little")]
        self.index = np.frombuffer(self.file.read_at(32 * count, self.index_at), "<i8").reshape(count, 4)
        self.reader = zstandard.ZstdDecompressor(**_settings(dictionary))

    def __len__(self) -> int:
        return len(self.index)

    def ids(self, row: int) -> np.ndarray:
        """Ids of the document at ``row``, by reading its frame alone."""
        return next(self.spans(row, row + 1))

    def spans(self, lo: int, hi: int) -> Iterator[np.ndarray]:
        """Ids of the documents in rows [lo, hi), by one read."""
        ends = [*self.index[lo + 1:hi, 3].tolist(), int(self.index[hi, 3]) if hi < len(self) else self.index_at]
        base = int(self.index[lo, 3])
        raw = memoryview(self.file.read_at(ends[-1] - base, base))
        for begin, end in zip(self.index[lo:hi, 3].tolist(), ends):
            yield np.frombuffer(self.reader.decompress(raw[begin - base:end - base]), self.kind).astype("<u4")


def _write(folder: str, tokenizer: str, end_id: int, dictionary: bytes, width: int):
    def run(batches):
        from pyspark import TaskContext

        own, at, index, sink, tokens = encoder(tokenizer), 48, [], None, 0
        writer = zstandard.ZstdCompressor(level=LEVEL, **_settings(dictionary))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = np.cumsum([len(t or "") for t in texts])
            edges = np.flatnonzero(np.diff(sizes // BATCH_BYTES, prepend=-1)).tolist() + [len(texts)]
            keys = batch.column(0).to_pylist()
            for lo, hi in zip(edges[:-1], edges[1:]):
                if sink is None:
                    name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tok"
                    system, path = _open(f"{folder}/shards/{name}")
                    sink = system.open_output_stream(path)
                    sink.write(MAGIC + hashlib.sha256(dictionary).digest() + width.to_bytes(8, "little"))
                for key, ids in zip(keys[lo:hi], own.encode(texts[lo:hi], end_id)):
                    frame = writer.compress(np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes())
                    sink.write(frame)
                    index.append((key or 0, key is None, len(ids) // 4, at))
                    at += len(frame)
                    tokens += len(ids) // 4
        if sink is not None:
            sink.write(np.array(index, dtype="<i8").tobytes() + np.array([len(index), at], dtype="<i8").tobytes() + TAIL)
            sink.close()
            yield pa.RecordBatch.from_pydict({
                "shard": [TaskContext.get().partitionId()], "name": [name], "documents": [len(index)], "tokens": [tokens],
            })

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> None:
    """Encode every whole ``docs(doc_id, text)`` and write the ids, each document with ``end_id`` behind it.

    Shards and the documents in them ascend by doc_id (null first, repeated ids by text); null text counts as empty.
    ``folder`` must be reachable from the driver and all executors; ``tokenizer`` is the path of the tokenizer's file.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    short = texts.where(F.length("text") <= SAMPLE_CHARS).select(F.xxhash64("doc_id").alias("h"), "doc_id", "text")
    # About twice as many as are taken come from all tasks together, whatever the number of tasks is.
    one_in = max(1, short.count() // (2 * SAMPLE_DOCUMENTS))
    chosen = (
        short.where(F.pmod("h", F.lit(one_in)) == 0).orderBy("h", "doc_id", "text").limit(SAMPLE_DOCUMENTS).collect()
    )
    own = encoder(tokenizer)
    width = 2 if max(own.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    samples = [np.frombuffer(x, "<u4").astype(f"<u{width}").tobytes() for x in own.encode([r.text for r in chosen], end_id)]
    dictionary = train_dictionary(samples)
    system, path = _open(folder)
    system.create_dir(f"{path}/shards", recursive=True)
    with system.open_output_stream(f"{path}/dictionary.bin") as sink:
        sink.write(dictionary)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    shards = cut(
        ordered.mapInArrow(
            _write(folder, tokenizer, end_id, dictionary, width), "shard long, name string, documents long, tokens long"
        )
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards.select(
        "shard", "name", "documents", "tokens", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start")
    ).write.mode("overwrite").parquet(f"{folder}/manifest")
    discard(shards)


def _read(folder: str, dictionary: bytes):
    def run(batches):
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(f"{folder}/shards/{name}", dictionary)
                doc, null, count = shard.index[:, 0], shard.index[:, 1] == 1, shard.index[:, 2]
                first = start + np.cumsum(count) - count
                groups = np.flatnonzero(np.diff(np.cumsum(count) * 4 // BATCH_BYTES, prepend=-1)).tolist() + [len(shard)]
                for lo, hi in zip(groups[:-1], groups[1:]):
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(doc[lo:hi], mask=null[lo:hi]), "start": first[lo:hi], "n_tokens": count[lo:hi],
                        "ids": pa.array([x.tobytes() for x in shard.spans(lo, hi)], type=pa.binary()),
                    })

    return run


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a token folder: ``doc_id, start`` (ids of all documents before), ``n_tokens``, ``ids``.

    ``ids`` is binary: little-endian unsigned 32-bit integers.
    """
    system, path = _open(folder)
    with system.open_input_stream(f"{path}/dictionary.bin") as source:
        dictionary = source.read()
    manifest = spark.read.parquet(f"{folder}/manifest").select("name", "start", "shard")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(parts, "shard").select("name", "start").mapInArrow(
        _read(folder, dictionary), "doc_id long, start long, n_tokens long, ids binary"
    )
