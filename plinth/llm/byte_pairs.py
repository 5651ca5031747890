"""Byte-level BPE by a rank file: overlapping chunks, boundaries that agree, ids of the pieces.

A text is split by a pattern into matches, each of which has its ids for itself. Where a match begins, the pattern
starts afresh; so if two overlapping chunks of a text both begin a match at one place, they agree from there on. Only
near its end can a chunk differ from the whole text: where the end cuts off the last match, or one of the pattern's
literals (``'ll`` seen as ``'l``); ``MARGIN`` characters before it are not relied on. A text is never cut behind
white space, since the pattern asks what follows white space.

Long texts become rows of overlapping chunks that are matched in parallel. Per document, the chunks' boundaries are
stitched: a chunk is left at the first boundary that the next chunk has too. Where the overlap has none (a match longer
than the overlap), the whole text is matched on from the last sound boundary until the next chunk's boundaries are met.
The stitched segments are rows again and are encoded in parallel. A text of one chunk needs no stitching.
"""

from __future__ import annotations

import base64
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.words import lists

CHUNK_CHARS, OVERLAP_CHARS = 1 << 15, 1 << 9
CHUNKS_AT_ONCE = 16
MARGIN = 8  # characters; more than the longest literal of the pattern
BATCH_CHARS = 1 << 19
DECODED_ROWS = 256
CACHED_MATCHES = 200_000  # forgotten all at once when there are more; bounds memory, never results


class BytePairs:
    def __init__(self, path: str, pattern: str):
        self.path, self.pattern = path, regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def _ranks(self) -> dict[bytes, int]:
        with open(self.path, "rb") as lines:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}

    @cached_property
    def single(self):
        import tiktoken

        return tiktoken.Encoding("ranks", pat_str=self.pattern.pattern, mergeable_ranks=self._ranks(), special_tokens={}).encode_ordinary

    @cached_property
    def bytes(self) -> np.ndarray:
        ranks = self._ranks()
        table = np.full(max(ranks.values()) + 1, b"", dtype=object)
        for raw, rank in ranks.items():
            table[rank] = raw
        return table

    def encode(self, text: str) -> bytes:
        """Ids of a text that begins and ends at boundaries, as little-endian 32-bit integers."""
        matches = self.pattern.findall(text)
        if len(self.known) > CACHED_MATCHES:
            self.known.clear()
        for match in set(matches).difference(self.known):
            self.known[match] = np.array(self.single(match), dtype="<i4").tobytes()
        return b"".join(map(self.known.__getitem__, matches))

    def boundaries(self, text: str, start: int = 0) -> list[int]:
        return [m.start() for m in self.pattern.finditer(text, start)]

    def decode(self, ids) -> bytes:
        return b"".join(self.bytes[ids])


@lru_cache(maxsize=2)
def byte_pairs(path: str, pattern: str) -> BytePairs:
    """One coder per worker process, file and pattern."""
    return BytePairs(path, pattern)


def stitch(coder: BytePairs, text: str, starts: list[int], found: list[list[int]], span: int) -> list[int]:
    """Places where a text may be cut, first 0, last its length, from the boundaries of its chunks.

    ``starts`` are the chunks' places in the text, ``found`` the boundaries of each (from the text's start), ``span``
    the length of all chunks but the last.
    """
    cuts, chunk = [0], 0
    while chunk + 1 < len(starts):
        after = chunk + 1
        target = set(found[after])
        sound = [b for b in found[chunk] if cuts[-1] < b <= starts[chunk] + span - MARGIN]
        place = next((b for b in sound if b in target and not text[b - 1].isspace()), None)
        if place is None:
            for match in coder.pattern.finditer(text, sound[-1] if sound else cuts[-1]):
                begin = match.start()
                while after + 1 < len(starts) and begin >= starts[after + 1]:
                    after, target = after + 1, set(found[after + 1])
                if begin > cuts[-1] and begin in target and not text[begin - 1].isspace():
                    place = begin
                    break
            else:
                break
        cuts.append(place)
        chunk = after
    return [*cuts, len(text)]


def _chunked(chunk: int, overlap: int):
    """Task: rows ``_row, text`` -> overlapping chunks, cut in one pass over a text."""

    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                starts = range(0, len(text), chunk)
                for lo in range(0, len(starts), CHUNKS_AT_ONCE):
                    own = starts[lo:lo + CHUNKS_AT_ONCE]
                    yield pa.RecordBatch.from_pydict({
                        "_row": pa.array([key] * len(own), pa.string()), "_chunk": pa.array(range(lo, lo + len(own)), pa.int32()),
                        "_start": pa.array(own, pa.int32()), "part": pa.array([text[s:s + chunk + overlap] for s in own], pa.string()),
                    })

    return run


def _matched(path: str, pattern: str):
    def run(batches):
        coder = byte_pairs(path, pattern)
        for batch in batches:
            starts = batch.column(2).to_pylist()
            found = [[s + b for b in coder.boundaries(t)] for s, t in zip(starts, batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 lists(np.array([b for own in found for b in own], dtype=np.int64), np.array([len(x) for x in found]), pa.int64())],
                names=["_row", "_chunk", "_start", "_found"],
            )

    return run


def _segments(path: str, pattern: str, span: int):
    def run(key, texts, chunks):
        coder = byte_pairs(path, pattern)
        text = texts.column("text")[0].as_py()
        rows = sorted(zip(chunks.column("_start").to_pylist(), chunks.column("_found").to_pylist()))
        cuts = stitch(coder, text, [s for s, _ in rows], [f for _, f in rows], span)
        parts = [text[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.table({"_row": pa.array([key[0].as_py()] * len(parts), pa.string()), "_at": pa.array(cuts[:-1], pa.int64()),
                         "_part": pa.array(parts, pa.string())})

    return run


def _encoded(path: str, pattern: str, column: int):
    def run(batches):
        coder = byte_pairs(path, pattern)
        for batch in batches:
            texts, lo = batch.column(column).to_pylist(), 0
            while lo < len(texts):
                ids, hi, chars = [], lo, 0
                while hi < len(texts) and (hi == lo or chars < BATCH_CHARS):
                    chars += len(texts[hi] or "")
                    ids.append(coder.encode(texts[hi] or ""))
                    hi += 1
                flat = np.frombuffer(b"".join(ids), "<i4")
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [c for i, c in enumerate(part.columns) if i != column]
                    + [lists(flat, np.array([len(x) // 4 for x in ids]), pa.int32())],
                    names=[n for i, n in enumerate(part.schema.names) if i != column] + ["ids"],
                )
                lo = hi

    return run


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``docs(doc_id long, text)`` -> ``doc_id, ids array<int>``: one row per row, null text counting as empty.

    ``path`` is a file of ranks (base64 of the bytes, a space, the rank per line), ``pattern`` splits texts. Null or
    repeated doc_ids are ordinary rows. Needs no unique key: long rows are told apart by a key of their own.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    size = F.length("text")
    short = texts.where(size <= chunk).mapInArrow(_encoded(path, pattern, 1), "doc_id long, ids array<int>")
    # Rows with the same doc_id and text have the same ids, so one of them is encoded and the others are counted.
    long = (
        texts.where(size > chunk).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("_copies"))
        .select(
            F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.sha2("text", 256)).alias("_row"),
            "doc_id", "text", "_copies",
        )
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = long.select("_row", "text").mapInArrow(_chunked(chunk, overlap), "_row string, _chunk int, _start int, part string")
    found = chunks.repartition(parts, "_row", "_chunk").mapInArrow(
        _matched(path, pattern), "_row string, _chunk int, _start int, _found array<long>"
    )
    segments = long.select("_row", "text").groupBy("_row").cogroup(found.groupBy("_row")).applyInArrow(
        _segments(path, pattern, chunk + overlap), "_row string, _at long, _part string"
    )
    encoded = segments.repartition(parts, "_row", "_at").mapInArrow(
        _encoded(path, pattern, 2), "_row string, _at long, ids array<int>"
    )
    whole = encoded.groupBy("_row").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_at", "ids"))), lambda x: x["ids"])).alias("ids")
    )
    again = long.select("_row", "doc_id", F.explode(F.sequence(F.lit(1), "_copies")).alias("_copy"))
    return short.unionByName(again.join(whole, "_row").select("doc_id", "ids"))


def _decoded(path: str, pattern: str, column: int):
    def run(batches):
        coder = byte_pairs(path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, DECODED_ROWS):
                part = batch.slice(lo, DECODED_ROWS)
                raw = [coder.decode(x.values.to_numpy()) if x.is_valid else None for x in part.column(column)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, type=pa.binary())], names=[*part.schema.names, "decoded"])

    return run


def decode(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``rows`` with ``decoded`` (binary): the bytes of ``ids`` one after another; null ids give null. A column of that name is replaced."""
    rows = rows.drop("decoded")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_decoded(path, pattern, rows.columns.index("ids")), f"{kinds}, decoded binary")
