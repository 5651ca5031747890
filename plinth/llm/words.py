"""Words of whole texts as numpy arrays: spans, 64-bit hashes and hashes of word sequences.

Texts are read from the Arrow buffers of a batch, about a megabyte at a time, so memory does not follow the batch.
A document's text is never cut: a longer one is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_CYCLE = 1 << 16

_WORD = np.ones(256, dtype=bool)
_WORD[list(SPACES)] = False


def _seeded(count: int, seed: int) -> np.ndarray:
    """``count`` fixed 64-bit values."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit bijection that spreads every input bit (xor-shift and multiply, three rounds)."""
    x = np.array(x, dtype=np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def _byte_codes(fold: bool) -> np.ndarray:
    codes = _seeded(256, 77)
    codes[list(SPACES)] = 0
    if fold:
        codes[65:91] = codes[97:123]
    return codes


CODES = {False: _byte_codes(False), True: _byte_codes(True)}
_POWERS = np.concatenate([[np.uint64(1)], np.cumprod(np.full(_CYCLE - 1, 0xD1342543DE82EF95, dtype=np.uint64))])


class Slice:
    """Some whole documents of one batch: ``rows`` [lo, hi), their bytes and the words in them.

    ``start``/``end`` are byte positions in ``data``, ``doc`` is the row (from ``lo``) of each word and
    ``first`` holds, per row, the number of words before it (one entry more than rows).
    """

    def __init__(self, lo: int, hi: int, data: np.ndarray, offsets: np.ndarray):
        self.lo, self.hi, self.data, self.offsets = lo, hi, data, offsets
        word = _WORD[data]
        before = np.zeros(len(data), dtype=bool)
        after = np.zeros(len(data), dtype=bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        full = offsets[:-1] < offsets[1:]
        before[offsets[:-1][full]] = False
        after[offsets[1:][full] - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, offsets, side="left")
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(hi - lo), self.count)

    def hashes(self, fold: bool) -> np.ndarray:
        """A 64-bit hash per word; with ``fold``, A-Z count as a-z."""
        if not len(self.start):
            return np.empty(0, dtype=np.uint64)
        origin = self.start[0]
        lengths = np.diff(self.start, append=len(self.data))
        place = np.arange(origin, len(self.data)) - np.repeat(self.start, lengths)
        parts = CODES[fold][self.data[origin:]] * _POWERS[place & (_CYCLE - 1)]
        return mix(np.add.reduceat(parts, self.start - origin))

    def raw(self, row: int) -> bytes:
        return self.data[self.offsets[row]:self.offsets[row + 1]].tobytes()


def sequences(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of every ``length`` consecutive entries (len - length + 1 of them)."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(count, length + (seed << 8), dtype=np.uint64)
    for j in range(length):
        total = total * np.uint64(0xA0761D6478BD642F) + hashes[j:j + count]
        total ^= total >> np.uint64(29)
    return mix(total)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut an Arrow string array into slices of whole documents; null counts as empty."""
    texts = pa.array(texts.fill_null(""), type=pa.large_string()) if texts.type != pa.large_string() else texts.fill_null("")
    if not len(texts):
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.empty(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield Slice(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the number of values per row."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=kind))
