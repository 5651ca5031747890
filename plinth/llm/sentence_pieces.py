"""SentencePiece ids of whole texts for merge-type vocabularies, by a score-ordered agenda of adjacent symbol pairs.

A text begins as one symbol per character. The agenda holds every adjacent pair that makes a piece of the vocabulary, best
score first and then leftmost; the pair on top becomes one symbol and brings its new neighbours onto the agenda. Symbols
that are no piece fall back to their bytes.

No merge crosses two characters that stand side by side in no piece, so a text is cut there first and the agenda runs within
the parts; parts recur, and each worker keeps the ids of those it meets often. The new parts of an Arrow batch share one agenda
in arrays, from which each part takes its best pair per step; a long part has an agenda of its own, a heap.

The ``sentencepiece`` library rewrites a whole text and then merges. Both are compared with it, and a difference is an error:
every whole text as it stands after rewriting, and the ids of every part before its first use. Texts beyond ``CHECKED_CHARS``
are compared in slices that begin where a run of spaces does, which bounds what the library holds.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections import defaultdict
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.words import lists

SPACE = "▁"
BATCH_CHARS, CHECKED_CHARS = 1 << 19, 1 << 20
CACHED_PARTS, CACHED_IDS = 400_000, 3_200_000  # beyond either the less used half is forgotten; bounds memory, never results
CHECKED_TOGETHER = 250  # new parts that the library encodes as one text
SHORT = 48  # characters of a part that is merged together with others and kept; below 64, which its places are packed by
NONE = np.iinfo(np.int64).max
DECODED_IDS = 1 << 18


class SentencePieces:
    """A vocabulary read through the library: merge type, byte fallback, texts kept as they are behind one space."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        for probe in ("a  b ", "ﬁ Ａ\t　é\n"):
            if library.normalize(probe) != SPACE + probe.replace(" ", SPACE):
                raise ValueError(f"{path} rewrites texts before it encodes them, which is not supported")
        self.count = size = library.get_piece_size()
        plain = [i for i in range(size) if not (library.is_unknown(i) or library.is_control(i) or library.is_byte(i) or library.is_unused(i))]
        self.ids = {library.id_to_piece(i): i for i in plain}
        self.bytes = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.longest = max(map(len, self.ids))
        if not all(map(library.is_byte, self.bytes)) or self.longest > 255:
            raise ValueError(f"{path} lacks byte pieces or has pieces of over 255 characters")
        scores = {p: library.get_score(i) for p, i in self.ids.items() if len(p) > 1}
        places = {s: n for n, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.order = {p: places[s] for p, s in scores.items()}
        self.beside = {p[i:i + 2] for p in self.order for i in range(len(p) - 1)}
        self.joined = {c for p in self.beside for c in p}
        self.parts = self._parts()
        # A character of no longer piece keeps parts apart that the library sees in one text.
        self.apart = next(c for c in map(chr, range(10, sys.maxunicode)) if c not in self.joined and c not in " " + SPACE)
        self._forget([])
        # Symbols of the array agenda: pieces by id, then joined characters that are no piece.
        loose = sorted(self.joined.difference(self.ids))
        symbols = self.ids | {c: size + n for n, c in enumerate(loose)}
        self.symbols, self.base = symbols, size + len(loose) + 1
        self.characters = np.full(sys.maxunicode + 1, self.base - 1, dtype=np.int64)
        for s, i in symbols.items():
            if len(s) == 1:
                self.characters[ord(s)] = i
        splits = sorted(
            (symbols[a] * self.base + symbols[b], self.order[p], i) for p, i in self.ids.items()
            for a, b in ((p[:k], p[k:]) for k in range(1, len(p))) if a in symbols and b in symbols
        )
        self.pairs, self.place, self.into = (np.array(c, dtype=np.int64) for c in zip(*splits))

    def _parts(self) -> re.Pattern:
        """Runs that merges stay within, in texts with plain spaces: spaces lead a word unless some piece has one behind
        another character."""
        joined = {c.replace(SPACE, " ") for c in self.joined}
        cls = lambda chars: "[" + "".join(map(re.escape, sorted(chars))) + "]"
        if " " not in joined or any(p[1] == SPACE != p[0] for p in self.beside):
            return re.compile(f"{cls(joined)}+|[^{cls(joined)[1:]}", re.S)
        return re.compile(f" *{cls(joined - {' '})}+| +|[^{cls(joined)[1:]}", re.S)

    def merged(self, text: str) -> list[str]:
        """Symbols of one part after all merges, best pair first.

        An entry of the agenda is one integer: place of the score, left symbol, characters of the pair. An entry is
        out of date when the symbol is gone or the pair has another length by now, since symbols only ever grow.
        """
        n = len(text)
        ends, after, before = array("l", range(1, n + 1)), array("l", range(1, n + 1)), array("l", range(-1, n - 1))
        order = self.order
        agenda = [(order[p] << 40 | i) << 8 | 2 for i in range(n - 1) if (p := text[i:i + 2]) in order]
        heapify(agenda)
        while agenda:
            top = heappop(agenda)
            length, left = top & 255, top >> 8 & (1 << 40) - 1
            right = after[left]
            if ends[left] < 0 or right >= n or ends[right] - left != length:
                continue
            ends[left], ends[right] = ends[right], -1
            after[left] = follower = after[right]
            if follower < n:
                before[follower] = left
                if (place := order.get(text[left:ends[follower]])) is not None:
                    heappush(agenda, (place << 40 | left) << 8 | ends[follower] - left)
            leader = before[left]
            if leader >= 0 and (place := order.get(text[leader:ends[left]])) is not None:
                heappush(agenda, (place << 40 | leader) << 8 | ends[left] - leader)
        out, at = [], 0
        while at < n:
            out.append(text[at:ends[at]])
            at = after[at]
        return out

    def _found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place on the agenda (``NONE``: no piece) and merged symbol of adjacent symbols."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.place[at], NONE), self.into[at]

    def merged_together(self, parts: list[str]) -> list[bytes]:
        """Ids of short parts, all merged at once: per step each part takes its best and then leftmost pair."""
        symbol = self.characters[np.frombuffer("".join(parts).encode("utf-32-le"), dtype="<u4")]
        owner = np.repeat(np.arange(len(parts)), np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        same = np.append(owner[1:] == owner[:-1], False)
        place, into = self._found(symbol, np.append(symbol[1:], 0))
        place[~same] = NONE
        while len(symbol):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(first, append=len(symbol))
            spot = np.arange(len(symbol)) - np.repeat(first, sizes)
            top = np.minimum.reduceat(np.where(place < NONE, place << 6 | spot, NONE), first)
            live = top < NONE
            rest = np.repeat(live, sizes)
            done.append((owner[~rest], symbol[~rest]))
            at = (first + (top & 63))[live]
            symbol[at] = into[at]
            rest[at + 1] = False
            moved = np.zeros(len(symbol), dtype=bool)
            moved[at] = True
            moved[np.maximum(at - 1, 0)] = True
            owner, symbol, place, into, moved = owner[rest], symbol[rest], place[rest], into[rest], np.flatnonzero(moved[rest])
            following = np.minimum(moved + 1, len(symbol) - 1)
            place[moved], into[moved] = self._found(symbol[moved], symbol[following])
            place[moved[(following == moved) | (owner[moved] != owner[following])]] = NONE
        owner, symbol = (np.concatenate(c) for c in zip(*done))
        order = np.argsort(owner, kind="stable")
        raw, ends = symbol[order].astype("<i4").tobytes(), (4 * np.cumsum(np.bincount(owner, minlength=len(parts)))).tolist()
        out = [raw[a:b] for a, b in zip([0, *ends], ends)]
        for i in np.unique(owner[symbol >= self.count]).tolist():
            out[i] = self.merged_alone(parts[i])
        return out

    def merged_alone(self, part: str) -> bytes:
        """Ids of one part by a heap per stretch of characters that may merge, with bytes for what is no piece."""
        symbols, start = [], 0
        for i in range(1, len(part) + 1):
            if i == len(part) or part[i - 1:i + 1] not in self.beside:
                symbols += self.merged(part[start:i]) if i - start > 1 else [part[start]]
                start = i
        ids = []
        for s in symbols:
            i = self.ids.get(s)
            ids += [i] if i is not None else [self.bytes[b] for b in s.encode()]
        return np.array(ids, dtype="<i4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text without an end id, as little-endian 32-bit integers."""
        flat, counts = self.encoded(texts)
        raw, ends = flat.tobytes(), (4 * np.cumsum(counts)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, without end ids, and their number per text."""
        self.check_rewriting(texts)
        if len(self.starts) > CACHED_PARTS or len(self.flat) > CACHED_IDS:
            met = list(self.known.items())
            places = np.array([i for _, i in met], dtype=np.int64)
            best = np.argsort(-self.uses[places], kind="stable")[:CACHED_PARTS // 2]
            best = best[np.cumsum(self.lengths[places[best]]) <= CACHED_IDS // 2]
            self._forget([met[i] for i in best.tolist()])
        split = [self.parts.findall(" " + t.replace(SPACE, " ")) if t else [] for t in texts]
        sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        old = len(self.known)
        index = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(sizes.sum()))
        new = list(islice(reversed(self.known), len(self.known) - old))[::-1]
        try:
            self._learn([p.replace(" ", SPACE) for p in new])
        except ValueError:
            self._forget([])
            raise
        for p in new:
            if len(p) > SHORT:
                del self.known[p]
        self.uses += np.bincount(index, minlength=len(self.uses))
        lengths = self.lengths[index]
        ends = np.append(0, np.cumsum(lengths))
        flat = self.flat[np.repeat(self.starts[index] - ends[:-1], lengths) + np.arange(ends[-1])]
        return flat, np.diff(ends[np.append(0, np.cumsum(sizes))])

    def _forget(self, kept: list[tuple[str, int]]) -> None:
        """Begin anew with these parts: ``known`` gives a part its place, ``starts`` and ``lengths`` give a place its ids in ``flat``."""
        self.known: dict[str, int] = defaultdict(count(len(kept)).__next__, zip((p for p, _ in kept), range(len(kept))))
        if not kept:
            self.flat = np.zeros(0, dtype="<i4")
            self.starts, self.lengths, self.uses = (np.zeros(0, dtype=np.int64) for _ in range(3))
            return
        places = np.array([i for _, i in kept], dtype=np.int64)
        before, self.lengths, self.uses = self.starts[places], self.lengths[places], self.uses[places] // 2
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = self.flat[np.repeat(before - self.starts, self.lengths) + np.arange(self.lengths.sum())]

    def _learn(self, new: list[str]) -> None:
        """Add the ids of new parts in the order of their places, after a comparison with the library's."""
        if not new:
            return
        short = [p for p in new if len(p) <= SHORT]
        together = iter(self.merged_together(short) if short else ())
        found = [next(together) if len(p) <= SHORT else self.merged_alone(p) for p in new]
        self.check_parts(new, found)
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        self.starts = np.append(self.starts, len(self.flat) + np.cumsum(lengths) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.uses = np.append(self.uses, np.zeros(len(new), dtype=np.int64))
        self.flat = np.append(self.flat, np.frombuffer(b"".join(found), "<i4"))

    def check_rewriting(self, texts: list[str]) -> None:
        """Raise where the library rewrites a text in another way than spaces to their mark, behind one more."""
        for text in texts:
            for s in self.slices(text) if text else ():
                if self.library.normalize(s) != SPACE + s.replace(" ", SPACE):
                    raise ValueError(f"the library rewrites the text that begins {text[:80]!r}")

    def check_parts(self, parts: list[str], found: list[bytes]) -> None:
        """Raise where the library has other ids for a part; a text holds many, each behind a character that never merges."""
        first, lead = self.merged_alone(SPACE), self.merged_alone(self.apart)
        groups = [slice(lo, lo + CHECKED_TOGETHER) for lo in range(0, len(parts), CHECKED_TOGETHER)]
        self.check(
            [self.apart + self.apart.join(parts[g]) for g in groups], [first + lead + lead.join(found[g]) for g in groups]
        )

    def slices(self, text: str, limit: int = CHECKED_CHARS) -> list[str]:
        """The text in slices of about ``limit`` characters, whose ids in a row are those of the text.

        A slice begins behind the first space of a run of spaces; the library puts that space back, but before nothing
        (so the last slice is not empty).
        """
        if len(text) <= limit or any(p[1] == SPACE != p[0] for p in self.beside):
            return [text]
        out, start, word = [], 0, re.compile(f"[^ {SPACE}](?=[ {SPACE}].)", re.S)
        while len(text) - start > limit and (met := word.search(text, start + limit)):
            out.append(text[start:met.end()])
            start = met.end() + 1
        return out + [text[start:]]

    def check(self, texts: list[str], found: list[bytes]) -> None:
        """Raise where the library has other ids for a text."""
        cut = [self.slices(t) for t in texts]
        own = [np.array(ids, dtype="<i4").tobytes() for ids in self.library.encode([s for c in cut for s in c], num_threads=1)]
        at = 0
        for text, slices, ids in zip(texts, cut, found):
            if b"".join(own[at:at + len(slices)]) != ids:
                raise ValueError(f"ids differ from the library's for the text that begins {text[:80]!r}")
            at += len(slices)


@lru_cache(maxsize=2)
def sentence_pieces(path: str) -> SentencePieces:
    """One coder per worker process and file."""
    return SentencePieces(path)


@lru_cache(maxsize=2)
def processor(path: str):
    """The library alone, which is all that decoding takes."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _encoded(path: str, end: bool):
    def run(batches):
        coder = sentence_pieces(path)
        eos = coder.library.eos_id()
        for batch in batches:
            texts, lo = batch.column(1), 0
            while lo < batch.num_rows:
                some, hi, chars = [], lo, 0
                while hi < batch.num_rows and (hi == lo or chars < BATCH_CHARS):
                    some.append(texts[hi].as_py() or "")
                    chars += len(some[-1])
                    hi += 1
                flat, counts = coder.encoded(some)
                if end:
                    flat, counts = np.insert(flat, np.cumsum(counts), eos), counts + 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), lists(flat, counts, pa.int32())],
                    names=["doc_id", "ids"],
                )
                lo = hi

    return run


def encode(docs: DataFrame, path: str, end: bool = True) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id long, ids array<int>``: one row per row, with the end id behind each text.

    ``path`` is a model of merge type with byte fallback, on the machine of every worker. A null text counts as empty
    and has the end id only; null or repeated doc_ids are ordinary rows; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_encoded(path, end), "doc_id long, ids array<int>")


def _decoded(path: str, column: int):
    def run(batches):
        library = processor(path)
        for batch in batches:
            ids, lo = batch.column(column), 0
            while lo < batch.num_rows:
                some, hi, count = [], lo, 0
                while hi < batch.num_rows and (hi == lo or count < DECODED_IDS):
                    some.append(ids[hi].values.to_numpy().tolist() if ids[hi].is_valid else None)
                    count += len(some[-1] or ())
                    hi += 1
                there = iter(library.decode([x for x in some if x is not None], num_threads=1) or ())
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([None if x is None else next(there) for x in some], type=pa.string())],
                    names=[*part.schema.names, "decoded"],
                )
                lo = hi

    return run


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``decoded``: the library's text for ``ids``; null ids give null. A column of that name is replaced."""
    rows = rows.drop("decoded")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_decoded(path, rows.columns.index("ids")), f"{kinds}, decoded string")
