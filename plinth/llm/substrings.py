"""Substring de-duplication with super-k-mers.

A window is a run of ``window`` consecutive words of one document. The minimiser of a window is the smallest hash among
its three-word sequences; it depends on the words alone, so equal windows have equal minimisers. Consecutive windows
with the same minimiser overlap in all but one word each; they travel as one packed string (a super-k-mer) to the bucket
of the minimiser, where the windows are taken out again, sorted and compared word for word.

Three shuffles, none of which knows a hot key:

1. documents by a hash of doc_id into chunks (used twice: by step 2 and by step 3),
2. the super-k-mers of a chunk by bucket. Equal ones of a chunk collapse first, so a passage that a third of all documents
   carry reaches its bucket once per chunk,
3. for each chunk and bucket, the smallest doc_id that holds each window of the packed strings, in their order. The
   chunk packs its documents again (the order follows from the words and doc_ids alone) and reads the values off.

Chunks and buckets follow ``spark.sql.shuffle.partitions``; one chunk or one bucket is in memory at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.words import Slice, sequences, slices

WINDOW = 13
MINIMISER = 3
CHUNKS_PER_PARTITION, BUCKETS_PER_PARTITION = 2, 2
LEVEL = 6  # of zstandard: the packed strings are most of what is shuffled
NOBODY = np.iinfo(np.int64).max


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in about log2(width) passes."""
    span, low = 1, values
    while span * 2 <= width:
        low = np.minimum(low[:len(low) - span], low[span:])
        span *= 2
    return np.minimum(low[:len(low) - (width - span)], low[width - span:]) if span < width else low


class Windows:
    """All windows of a slice: position of the first word, two hashes, and the minimiser."""

    def __init__(self, piece: Slice, window: int, usable: np.ndarray | None = None, minimisers: bool = False):
        hashes = piece.hashes(fold=False)
        total = len(hashes) - window + 1
        self.at = np.empty(0, dtype=np.int64)
        if total > 0:
            own = piece.doc[:total] == piece.doc[window - 1:]
            if usable is not None:
                own &= usable[piece.doc[:total]]
            self.at = np.flatnonzero(own)
        if not len(self.at):
            self.one = self.two = self.least = np.empty(0, dtype=np.uint64)
            return
        self.one = sequences(hashes, window)[self.at]
        self.two = sequences(hashes ^ np.uint64(0x3C6EF372FE94F82B), window, seed=1)[self.at]
        if minimisers:
            width = min(MINIMISER, window)
            self.least = _sliding_min(sequences(hashes, width), window - width + 1)[self.at]


class Packed:
    """The words of a slice joined by single spaces (one space follows every word)."""

    def __init__(self, piece: Slice):
        self.lengths = piece.end - piece.start
        self.start = np.cumsum(self.lengths + 1) - (self.lengths + 1)
        self.data = np.full(int((self.lengths + 1).sum()), 32, dtype=np.uint8)
        letters = np.ones(len(self.data), dtype=bool)
        letters[self.start + self.lengths] = False
        inside = np.zeros(len(piece.data) + 1, dtype=np.int8)
        inside[piece.start] += 1
        inside[piece.end] -= 1
        self.data[letters] = piece.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]


def _dump(low: np.ndarray, high: np.ndarray, lengths: np.ndarray, text: bytes) -> bytes:
    head = np.array([len(low)], dtype=np.int64).tobytes()
    return zstandard.compress(head + low.tobytes() + high.tobytes() + lengths.astype(np.int64).tobytes() + text, LEVEL)


def _load(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    low, high, lengths = (np.frombuffer(raw, np.int64, n, 8 + 8 * n * k) for k in range(3))
    return low, high, lengths, raw[8 + 24 * n:]


class Chunk:
    """The super-k-mers of a chunk of documents.

    Per occurrence (in text order): ``group``. Per group of equal super-k-mers, ordered by bucket, size and hashes:
    ``bucket``, ``low`` and ``high`` (smallest and largest doc_id), ``begin`` and ``size`` in ``data``, ``windows``.
    """

    def __init__(self, table: pa.Table, window: int, buckets: int):
        column = table.column("doc_id").combine_chunks()
        self.ids = column.fill_null(0).to_numpy(zero_copy_only=False)
        known = ~column.is_null().to_numpy(zero_copy_only=False)
        self.pieces, self.found = list(slices(table.column("text").combine_chunks())), []
        parts, data, base = [], [], 0
        for piece in self.pieces:
            found = Windows(piece, window, known[piece.lo:piece.hi], minimisers=True)
            self.found.append(found)
            at, doc = found.at, piece.doc[found.at]
            if not len(at):
                found.count = np.empty(0, dtype=np.int64)
                continue
            new = np.ones(len(at), dtype=bool)
            new[1:] = (found.least[1:] != found.least[:-1]) | (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new)
            found.count = np.diff(first, append=len(at))
            packed = Packed(piece)
            begin, last = packed.start[at[first]], at[first] + found.count + window - 2
            parts.append((
                (found.least[first] % np.uint64(buckets)).astype(np.int64), np.add.reduceat(found.one, first),
                np.add.reduceat(found.two, first), self.ids[piece.lo:piece.hi][doc[first]], begin + base,
                packed.start[last] + packed.lengths[last] - begin, found.count,
            ))
            data.append(packed.data)
            base += len(packed.data)
            found.one = found.two = found.least = None
        if not parts:
            parts = [tuple(np.empty(0, dtype=np.int64) for _ in range(7))]
        self.data = np.concatenate(data) if data else np.empty(0, np.uint8)
        bucket, one, two, owner, begin, size, count = (np.concatenate([p[k] for p in parts]) for k in range(7))
        order = np.lexsort((owner, two, one, size, bucket))
        new = np.ones(len(order), dtype=bool)
        for key in (bucket, size, one, two):
            new[1:] &= key[order][1:] == key[order][:-1]
        new[1:] = ~new[1:]
        first = np.flatnonzero(new)
        self.group = np.empty(len(order), dtype=np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.low = owner[order][first]
        self.high = np.maximum.reduceat(owner[order], first) if len(first) else self.low
        self.bucket, self.begin, self.size, self.windows = (x[order][first] for x in (bucket, begin, size, count))

    def buckets(self):
        edges = np.flatnonzero(np.concatenate([[True], self.bucket[1:] != self.bucket[:-1], [True]])) if len(self.bucket) else []
        return zip(edges[:-1], edges[1:])


def _super_kmers(window: int, buckets: int):
    """Chunk of documents -> one row per bucket with the chunk's distinct super-k-mers."""

    def run(key, table):
        chunk = Chunk(table, window, buckets)
        rows = {"bucket": [], "chunk": [], "packed": []}
        raw = memoryview(chunk.data)
        for lo, hi in chunk.buckets():
            begin, size = chunk.begin[lo:hi], chunk.size[lo:hi]
            text = b"".join([raw[b:b + s] for b, s in zip(begin.tolist(), size.tolist())])
            rows["bucket"].append(int(chunk.bucket[lo]))
            rows["chunk"].append(key[0].as_py())
            rows["packed"].append(_dump(chunk.low[lo:hi], chunk.high[lo:hi], size, text))
        return pa.table(rows, schema=pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("packed", pa.binary())]))

    return run


def _first_holders(window: int):
    """Bucket of super-k-mers -> per chunk, the smallest doc_id of each window that precedes a document of the chunk."""

    def run(key, table):
        loaded = [_load(x) for x in table.column("packed").to_pylist()]
        low, high, lengths = (np.concatenate([x[k] for x in loaded]) for k in range(3))
        data = b"".join(x[3] for x in loaded)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        texts = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data))
        owner, one, two, begin, end = [], [], [], [], []
        for piece in slices(texts):
            found = Windows(piece, window)
            owner.append(piece.lo + piece.doc[found.at])
            one.append(found.one)
            two.append(found.two)
            begin.append(offsets[piece.lo] + piece.start[found.at])
            end.append(offsets[piece.lo] + piece.end[found.at + window - 1])
        owner, one, two, begin, end = (np.concatenate(x) for x in (owner, one, two, begin, end))
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        first = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
        size = np.diff(first, append=len(one))
        least = np.repeat(np.minimum.reduceat(low[owner[order]], first), size)
        for lo, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
            at = order[lo:lo + n]
            held = [data[b:e] for b, e in zip(begin[at].tolist(), end[at].tolist())]
            if held.count(held[0]) != n:  # the hashes agree, the words don't
                own: dict[bytes, int] = {}
                for text, doc in zip(held, low[owner[at]].tolist()):
                    own[text] = min(doc, own.get(text, doc))
                least[lo:lo + n] = [own[text] for text in held]
        holder = np.empty(len(order), dtype=np.int64)
        holder[order] = least
        holder[holder >= high[owner]] = NOBODY
        chunk_of = np.repeat(np.arange(len(loaded)), [len(x[0]) for x in loaded])[owner]
        edges = np.searchsorted(chunk_of, np.arange(len(loaded) + 1))
        rows = {"chunk": [], "bucket": [], "holders": []}
        for chunk, lo, hi in zip(table.column("chunk").to_pylist(), edges[:-1], edges[1:]):
            if (holder[lo:hi] != NOBODY).any():
                rows["chunk"].append(chunk)
                rows["bucket"].append(key[0].as_py())
                rows["holders"].append(zstandard.compress(holder[lo:hi].tobytes(), 3))
        return pa.table(rows, schema=pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("holders", pa.binary())]))

    return run


def _kept(piece: Slice, drop: np.ndarray) -> pa.Array:
    """Text of each row of a slice without the dropped words, the others joined by one space."""
    packed = Packed(piece)
    keep = ~drop
    sizes = np.where(keep, packed.lengths + 1, 0)
    rows = piece.hi - piece.lo
    last = np.full(rows, -1, dtype=np.int64)
    stay = np.flatnonzero(keep)
    last[piece.doc[stay]] = stay  # the last one written wins
    letters = np.repeat(keep, packed.lengths + 1)
    tails = last[last >= 0]
    letters[packed.start[tails] + packed.lengths[tails]] = False
    sizes[tails] -= 1
    ends = np.concatenate([[0], np.cumsum(np.bincount(piece.doc, weights=sizes, minlength=rows).astype(np.int64))])
    return pa.LargeStringArray.from_buffers(rows, pa.py_buffer(ends.tobytes()), pa.py_buffer(packed.data[letters].tobytes()))


def _removed(window: int, buckets: int, carry: Sequence[str], as_is: bool):
    """Chunk of documents and the holders of its windows -> documents without the words that preceded windows cover."""

    def run(key, docs, found):
        chunk = Chunk(docs, window, buckets)
        holders = dict(zip(found.column("bucket").to_pylist(), found.column("holders").to_pylist()))
        first = np.cumsum(chunk.windows) - chunk.windows  # of each group, in ``holder``
        holder = np.full(int(chunk.windows.sum()), NOBODY, dtype=np.int64)
        for lo, hi in chunk.buckets():
            if blob := holders.get(int(chunk.bucket[lo])):
                own = np.frombuffer(zstandard.decompress(blob), np.int64)
                holder[first[lo]:first[lo] + len(own)] = own
        texts, words, removed, done = [], [], [], 0
        for piece, own in zip(chunk.pieces, chunk.found):
            group = chunk.group[done:done + len(own.count)]
            done += len(own.count)
            place = np.arange(len(own.at)) - np.repeat(np.cumsum(own.count) - own.count, own.count)
            hit = holder[np.repeat(first[group], own.count) + place] < chunk.ids[piece.lo:piece.hi][piece.doc[own.at]]
            cover = np.zeros(len(piece.start) + 1, dtype=np.int64)
            cover[own.at[hit]] += 1
            cover[own.at[hit] + window] -= 1  # at most one window starts at a word
            drop = np.cumsum(cover[:-1]) > 0
            texts.append(_kept(piece, drop))
            words.append(piece.count)
            removed.append(np.bincount(piece.doc, weights=drop, minlength=piece.hi - piece.lo).astype(np.int64))
        kept = pa.chunked_array(texts, type=pa.large_string()).cast(pa.string())
        gone = pa.array(np.concatenate(removed) if removed else [], type=pa.int64())
        if as_is:
            kept = pc.if_else(pc.equal(gone, 0), docs.column("text"), kept)
        return pa.table({
            "doc_id": docs.column("doc_id"),
            "n_words": pa.array(np.concatenate(words) if words else [], type=pa.int64()),
            "n_removed": gone,
            "kept": kept,
        } | {c: docs.column(c) for c in carry})

    return run


def without_repeats(docs: DataFrame, window: int = WINDOW, carry: Sequence[str] = (), as_is: bool = False) -> DataFrame:
    """``docs(doc_id long, text, *carry)`` -> per row ``doc_id, n_words, n_removed, kept, *carry``.

    Words are runs of other bytes than space and 0x09-0x0D, unchanged. A word goes if a window covers it whose words also
    start somewhere in a document with a smaller doc_id. ``kept`` joins the rest by one space; with
    ``as_is`` it is the text itself where nothing goes.

    Null or empty texts have no words and come back as empty text. A null doc_id precedes nothing and loses nothing. Rows
    that repeat a doc_id don't precede each other. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks, buckets = CHUNKS_PER_PARTITION * parts, BUCKETS_PER_PARTITION * parts
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk")
    dealt = docs.select(
        chunk, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *carry
    ).repartition(parts, "chunk")
    kmers = dealt.groupBy("chunk").applyInArrow(_super_kmers(window, buckets), "bucket long, chunk long, packed binary")
    found = kmers.groupBy("bucket").applyInArrow(_first_holders(window), "chunk long, bucket long, holders binary")
    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return (
        dealt.groupBy("chunk").cogroup(found.groupBy("chunk"))
        .applyInArrow(_removed(window, buckets, carry, as_is), f"doc_id long, n_words long, n_removed long, kept string{kinds}")
    )


