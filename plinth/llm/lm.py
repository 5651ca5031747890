"""A three-word language model in an Elias-Fano trie, and the scores of whole texts.

Words are lower-cased runs; every text ends with one more token. Probabilities are interpolated (Witten-Bell): with
T(h) distinct followers of a context h that was seen c(h) times,

    P(w | h) = (c(hw) + T(h) P(w | h')) / (c(h) + T(h)),    P(w) = (c(w) + 1) / (N + V + 1)

where h' drops the first word, so an unseen w costs T(h) / (c(h) + T(h)) and a context that was never followed nothing.

The trie lies in a folder that all executors share and memory-map:

* level 1, one file per range of word hashes: the hashes, the counts and the back-off factors;
* level 2, one file per the same range of first words: pointers and second words as Elias-Fano sequences;
* level 3, one file per ``NODES`` pairs: pointers and third words. A third word is stored as its place among the
  followers of the second word, which is found there first: the context makes the numbers small.

Logarithms are quantised to steps of ``STEP``. Counts come from three passes over all training texts; each pass sorts
and sums its keys in batches and sends them to their file's task, so no task holds more than one file's keys. Words are
told apart by 64-bit hashes.
"""

from __future__ import annotations

import json
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.elias_fano import Level
from plinth.llm.words import mix, slices
from plinth.runtime import cut, discard

STEP = 1 / 2048
RANGE_TOKENS = 1 << 21  # training tokens per range of word hashes, about
NODES = 1 << 19
BATCH_TOKENS = 1 << 20
SCORE_TOKENS = 1 << 19  # scoring keeps twice as many arrays
END = mix(np.array([0x656E64], dtype=np.uint64))[0]


def _code(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 / STEP), 0, 65535).astype(np.uint16)


def _log(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) * -STEP


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri.removeprefix("file:"))


def save(folder: str, arrays: dict[str, np.ndarray]) -> str:
    """Write arrays as one file under a name of its own: length of the head, head, arrays at multiples of 64 bytes."""
    name, at, head = f"{uuid.uuid4().hex}.bin", 0, {}
    for key, array in arrays.items():
        head[key] = (array.dtype.str, len(array), at)
        at += -(-array.nbytes // 64) * 64
    raw = json.dumps(head).encode()
    raw += b" " * (-(len(raw) + 8) % 64)
    system, path = _open(folder)
    with system.open_output_stream(f"{path}/{name}") as sink:
        sink.write(len(raw).to_bytes(8, "little") + raw)
        for array in arrays.values():
            sink.write(array.tobytes() + bytes(-array.nbytes % 64))
    return name


@lru_cache(maxsize=4096)
def load(uri: str) -> dict[str, np.ndarray]:
    """Arrays of a file, memory-mapped where the file system is a mounted one."""
    system, path = _open(uri)
    source = pa.memory_map(path) if isinstance(system, pafs.LocalFileSystem) else system.open_input_file(path)
    raw = source.read_buffer() if not isinstance(source, pa.MemoryMappedFile) else source.read_buffer(source.size())
    size = int.from_bytes(raw[:8], "little")
    head = json.loads(bytes(raw[8:8 + size]))
    return {k: np.frombuffer(raw, np.dtype(kind), n, 8 + size + at) for k, (kind, n, at) in head.items()}


class Trie:
    """The files of a model. Words and pairs are numbered through all files; -1 stands for what was not seen."""

    def __init__(self, folder: str, shift: int, words: list[tuple], pairs: list[tuple], triples: dict[int, str], tokens: int,
                 nodes: int = NODES):
        self.folder, self.shift, self.files, self.triples = folder, shift, words, triples
        self.tokens, self.nodes = tokens, nodes
        self.word_base = np.concatenate([[0], np.cumsum([n for _, n in words])])
        self.pair_files = [name for name, _ in pairs]
        self.pair_base = np.concatenate([[0], np.cumsum([n for _, n in pairs])]) if pairs else np.array([0])
        self.vocabulary = int(self.word_base[-1])

    def words(self, part: int) -> dict[str, np.ndarray]:
        return load(f"{self.folder}/{self.files[part][0]}") if self.files[part][0] else {}

    def level(self, name: str) -> tuple[Level, dict[str, np.ndarray]]:
        arrays = load(f"{self.folder}/{name}")
        return Level(arrays), arrays

    def find_words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number, count and back-off code of each word."""
        distinct, back = np.unique(hashes, return_inverse=True)
        number, count, code = (np.full(len(distinct), x, dtype=np.int64) for x in (-1, 0, 0))
        edges = np.searchsorted(distinct >> np.uint64(self.shift), np.arange(len(self.files) + 1)) if self.shift < 64 else [0, len(distinct)]
        for part, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
            held = self.words(part)
            if lo == hi or not held:
                continue
            at = np.minimum(np.searchsorted(held["hash"], distinct[lo:hi]), len(held["hash"]) - 1)
            hit = held["hash"][at] == distinct[lo:hi]
            number[lo:hi][hit] = self.word_base[part] + at[hit]
            count[lo:hi][hit] = held["count"][at[hit]]
            if "backoff" in held:
                code[lo:hi][hit] = held["backoff"][at[hit]]
        return number[back], count[back], code[back]

    def find_pairs(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of each pair of words, its place among the followers of the first word, and its probability code."""
        number, place, code = (np.full(len(one), x, dtype=np.int64) for x in (-1, -1, 0))
        known = np.flatnonzero((one >= 0) & (two >= 0))
        keys, back = np.unique(one[known] * (self.vocabulary + 1) + two[known], return_inverse=True)
        first, second = np.divmod(keys, self.vocabulary + 1)
        found, where, prob = (np.full(len(keys), x, dtype=np.int64) for x in (-1, -1, 0))
        edges = np.searchsorted(first, self.word_base)
        for part, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
            if lo == hi or not self.pair_files[part]:
                continue
            level, arrays = self.level(self.pair_files[part])
            at, begin = level.find(first[lo:hi] - self.word_base[part], second[lo:hi])
            hit = np.flatnonzero(at >= 0)
            found[lo:hi][hit] = self.pair_base[part] + at[hit]
            where[lo:hi][hit] = at[hit] - begin[hit]
            prob[lo:hi][hit] = arrays["code"][at[hit]]
        number[known], place[known], code[known] = found[back], where[back], prob[back]
        return number, place, code

    def find_triples(self, pair: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability code of the follower at ``place`` of each pair (-1: not seen), and the pair's back-off code."""
        code, backoff = np.full(len(pair), -1, dtype=np.int64), np.zeros(len(pair), dtype=np.int64)
        known = np.flatnonzero(pair >= 0)
        span = int(place.max(initial=-1)) + 2
        keys, back = np.unique(pair[known] * span + place[known] + 1, return_inverse=True)
        one, two = np.divmod(keys, span)
        two -= 1
        found, held = np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        blocks = one // self.nodes
        edges = np.flatnonzero(np.diff(blocks, prepend=-1, append=-2))
        for lo, hi in zip(edges[:-1], edges[1:]):
            block = int(blocks[lo])
            if block not in self.triples:
                continue
            level, arrays = self.level(self.triples[block])
            node = one[lo:hi] - block * self.nodes
            held[lo:hi] = arrays["backoff"][node]
            ask = np.flatnonzero(two[lo:hi] >= 0)
            at, _ = level.find(node[ask], two[lo:hi][ask])
            hit = np.flatnonzero(at >= 0)
            found[lo + ask[hit]] = arrays["code"][at[hit]]
        code[known], backoff[known] = found[back], held[back]
        return code, backoff


def _tokens(texts: pa.Array):
    """Per slice of a batch: token hashes with an end after each text, and the row of each token."""
    for piece in slices(texts):
        ends = piece.first[1:]
        hashes = np.insert(piece.hashes(fold=True), ends, END)
        rows = np.insert(piece.doc, ends, np.arange(piece.hi - piece.lo))
        yield piece, hashes, rows


def _batched(batches):
    """Token hashes and rows of about ``BATCH_TOKENS`` tokens of whole texts."""
    held, rows, size, base = [], [], 0, 0
    for batch in batches:
        for piece, hashes, own in _tokens(batch.column(0)):
            held.append(hashes)
            rows.append(own + base)
            base += piece.hi - piece.lo
            size += len(hashes)
            if size >= BATCH_TOKENS:
                yield np.concatenate(held), np.concatenate(rows)
                held, rows, size, base = [], [], 0, 0
    if held:
        yield np.concatenate(held), np.concatenate(rows)


def _in_turn(texts: pa.Array, limit: int):
    """First row, number of rows, token hashes and the row of each token (from the first), of about ``limit`` tokens of whole texts."""
    held, rows, size, lo = [], [], 0, 0
    for piece, hashes, own in _tokens(texts):
        held.append(hashes)
        rows.append(own + piece.lo - lo)
        size += len(hashes)
        if size >= limit or piece.hi == len(texts):
            yield lo, piece.hi - lo, np.concatenate(held), np.concatenate(rows)
            held, rows, size, lo = [], [], 0, piece.hi


def _count_words(batches):
    for hashes, _ in _batched(batches):
        word, n = np.unique(hashes, return_counts=True)
        yield pa.RecordBatch.from_pydict({"word": word.view(np.int64), "n": n})


def _send(part: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One compressed row per part from columns sorted by part; keys (the first column) as differences."""
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-2))
    rows = []
    for lo, hi in zip(edges[:-1], edges[1:]):
        key = np.diff(columns[0][lo:hi], prepend=0)
        planes = key.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()  # equal bytes side by side
        rest = b"".join(c[lo:hi].astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns[1:])
        rows.append(zstandard.compress(planes + rest, 3))
    return pa.RecordBatch.from_pydict({"part": part[edges[:-1]].astype(np.int64), "packed": pa.array(rows, type=pa.binary())})


def _receive(table, columns: int) -> list[np.ndarray]:
    """Columns of all rows sent to one part, sorted by key."""
    parts = []
    for blob in table.column("packed").to_pylist():
        raw = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(columns, 8, -1)
        own = [np.ascontiguousarray(raw[c].T).reshape(-1).view("<i8") for c in range(columns)]
        parts.append([np.cumsum(own[0]), *own[1:]])
    joined = [np.concatenate(x) for x in zip(*parts)]
    order = np.argsort(joined[0], kind="stable")
    return [x[order] for x in joined]


def _summed(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct key of a sorted array, and the sum of its counts."""
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return first, np.add.reduceat(count, first)


def _write_words(folder: str):
    def run(key, table):
        word = table.column("word").to_numpy().view(np.uint64)
        order = np.argsort(word)
        name = save(folder, {"hash": word[order], "count": table.column("n").to_numpy()[order].astype(np.int64)})
        return pa.table({"part": [key[0].as_py()], "name": [name], "size": [len(word)]})

    return run


def _count_pairs(trie: Trie):
    def run(batches):
        for hashes, rows in _batched(batches):
            number, _, _ = trie.find_words(hashes)
            inside = rows[1:] == rows[:-1]
            key, n = np.unique(number[:-1][inside] * (trie.vocabulary + 1) + number[1:][inside], return_counts=True)
            part = np.searchsorted(trie.word_base, key // (trie.vocabulary + 1), side="right") - 1
            if len(key):
                yield _send(part, [key, n])

    return run


def _write_pairs(trie: Trie):
    def run(key, table):
        part = key[0].as_py()
        packed, count = _receive(table, 2)
        first, count = _summed(packed, count)
        one, two = np.divmod(packed[first], trie.vocabulary + 1)
        one -= trie.word_base[part]
        held = trie.words(part)
        parents = len(held["hash"])
        followers, seen = np.bincount(one, minlength=parents), np.bincount(one, weights=count, minlength=parents)
        counts = np.empty(len(two), dtype=np.int64)
        order = np.argsort(two, kind="stable")
        edges = np.searchsorted(two[order], trie.word_base)
        for other, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
            if lo < hi:
                counts[order[lo:hi]] = trie.words(other)["count"][two[order[lo:hi]] - trie.word_base[other]]
        lower = (counts + 1) / (trie.tokens + trie.vocabulary + 1)
        share = seen[one] + followers[one]
        prob = (count + followers[one] * lower) / share
        backoff = np.where(followers > 0, followers / np.maximum(seen + followers, 1), 1.0)
        pairs = save(trie.folder, Level.encode(parents, one, two) | {"code": _code(np.log10(prob))})
        words = save(trie.folder, dict(held) | {"backoff": _code(np.log10(backoff))})
        return pa.table({"part": [part], "pairs": [pairs], "words": [words], "size": [len(two)]})

    return run


def _count_triples(trie: Trie, bits: int):
    def run(batches):
        for hashes, rows in _batched(batches):
            number, _, _ = trie.find_words(hashes)
            pair, place, code = trie.find_pairs(number[:-1], number[1:])
            inside = rows[2:] == rows[:-2]
            key = (pair[:-1][inside] << bits) + place[1:][inside]
            order = np.argsort(key)  # equal keys have equal codes, so any of them stands for all
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            at, n = order[first], np.diff(first, append=len(key))
            if len(key):
                yield _send((key[at] >> bits) // trie.nodes, [key[at], n, code[1:][inside][at]])

    return run


def _write_triples(trie: Trie, bits: int):
    def run(key, table):
        block = key[0].as_py()
        packed, count, code = _receive(table, 3)
        first, count = _summed(packed, count)
        node, place = (packed[first] >> bits) - block * trie.nodes, packed[first] & ((1 << bits) - 1)
        lower = 10.0 ** _log(code[first])
        nodes = min(trie.nodes, int(trie.pair_base[-1]) - block * trie.nodes)
        followers, seen = np.bincount(node, minlength=nodes), np.bincount(node, weights=count, minlength=nodes)
        prob = (count + followers[node] * lower) / (seen[node] + followers[node])
        backoff = np.where(followers > 0, followers / np.maximum(seen + followers, 1), 1.0)
        name = save(trie.folder, Level.encode(nodes, node, place) | {"code": _code(np.log10(prob)), "backoff": _code(np.log10(backoff))})
        return pa.table({"block": [block], "name": [name]})

    return run


def _scored(trie: Trie, keep: int):
    def run(batches):
        for batch in batches:
            for lo, n, hashes, rows in _in_turn(batch.column(keep), SCORE_TOKENS):
                number, count, word_code = trie.find_words(hashes)
                base = np.log10((count + 1) / (trie.tokens + trie.vocabulary + 1))
                score = base.copy()
                pair, place, code = trie.find_pairs(number[:-1], number[1:])
                inside = rows[1:] == rows[:-1]
                two = np.where(pair >= 0, _log(code), base[1:] + _log(word_code[:-1]))
                score[1:][inside] = two[inside]
                triple, backoff = trie.find_triples(pair[:-1], place[1:])
                three = np.where(triple >= 0, _log(triple), two[1:] + _log(backoff))
                both = inside[1:] & inside[:-1]
                score[2:][both] = three[both]
                total = lambda x: np.bincount(rows, weights=x, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [c.slice(lo, n) for i, c in enumerate(batch.columns) if i != keep] + [
                        pa.array(np.bincount(rows, minlength=n)), pa.array(total(count > 0).astype(np.int64)),
                        pa.array(total(base)), pa.array(total(score)),
                    ],
                    names=[x for i, x in enumerate(batch.schema.names) if i != keep] + ["n_tokens", "n_known", "base_score", "score"],
                )

    return run


def train(texts: DataFrame, folder: str, range_tokens: int = RANGE_TOKENS, nodes: int = NODES) -> Trie:
    """The model of ``texts(text)`` in ``folder``, which the driver and all executors must reach. Null counts as empty."""
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    words = cut(texts.select("text").mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    tokens = words.agg(F.sum("n")).first()[0] or 0
    bits = max(0, (tokens // range_tokens).bit_length())
    shift = 64 - bits
    part = F.shiftrightunsigned("word", shift).alias("part") if bits else F.lit(0).cast("long").alias("part")
    rows = words.select(part, "word", "n").groupBy("part").applyInArrow(_write_words(folder), "part long, name string, size long").collect()
    discard(words)
    files = {r.part: (r.name, r.size) for r in rows}
    first = Trie(folder, shift, [files.get(i, ("", 0)) for i in range(1 << bits)], [], {}, tokens)
    sent = texts.select("text").mapInArrow(_count_pairs(first), "part long, packed binary")
    rows = sent.groupBy("part").applyInArrow(_write_pairs(first), "part long, pairs string, words string, size long").collect()
    pairs, named = {r.part: (r.pairs, r.size) for r in rows}, {r.part: (r.words, files[r.part][1]) for r in rows}
    parts = range(1 << bits)
    second = Trie(folder, shift, [named.get(i, files.get(i, ("", 0))) for i in parts], [pairs.get(i, ("", 0)) for i in parts], {}, tokens, nodes)
    place = max(1, second.vocabulary.bit_length())
    sent = texts.select("text").mapInArrow(_count_triples(second, place), "part long, packed binary")
    rows = sent.groupBy("part").applyInArrow(_write_triples(second, place), "block long, name string").collect()
    second.triples = {r.block: r.name for r in rows}
    return second


def score(docs: DataFrame, trie: Trie) -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens, n_known, base_score, score`` (log10) of each whole text.

    Null and empty texts are one end token. Extra columns stay, but for ones named like the results; any may be null.
    """
    docs = docs.drop("n_tokens", "n_known", "base_score", "score")
    keep = docs.columns.index("text")
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields if f.name != "text")
    return docs.mapInArrow(_scored(trie, keep), f"{kinds}n_tokens long, n_known long, base_score double, score double")


