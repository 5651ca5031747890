"""Elias-Fano sequences and trie levels as flat numpy arrays that can be memory-mapped, queried many at a time.

A non-decreasing sequence is split into low bits (one, two or no bytes per value) and high bits in unary: value i sets bit
``high(i) + i``. For every word of 64 bits the numbers of ones and of zeros before it are kept, so the k-th one or zero is
found from one entry of that directory and one word.
"""

from __future__ import annotations

import numpy as np

_LOWS = {0: None, 8: np.uint8, 16: np.uint16, 32: np.uint32}
_EACH, _TOP = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)  # a one, and the highest bit, in every byte
_PLACES = np.zeros((256, 8), dtype=np.uint64)  # place of the k-th one in a byte
for _byte in range(256):
    for _k, _place in enumerate(i for i in range(8) if _byte >> i & 1):
        _PLACES[_byte, _k] = _place
_PLACES = _PLACES.reshape(-1)


def encode(values: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of the sequence ``values`` (non-decreasing, not negative)."""
    n = len(values)
    top = int(values[-1]) if n else 0
    ideal = max(0, (top // n).bit_length() - 1) if n else 0
    low_bits = next(b for b in _LOWS if b >= min(ideal, 32) or b == 16 and ideal <= 22)
    high = values >> low_bits
    words = -(-(n + (top >> low_bits) + 2) // 64)
    flat = np.zeros(words * 64, dtype=np.uint8)
    flat[high + np.arange(n)] = 1
    upper = np.packbits(flat, bitorder="little").view(np.uint64)
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(upper), dtype=np.int64)])
    places = np.uint32 if words < 1 << 26 else np.int64
    kind = _LOWS[low_bits]
    return {
        "upper": upper, "ones": ones.astype(places), "zeros": (np.arange(words + 1) * 64 - ones).astype(places),
        "low": (values & ((1 << low_bits) - 1)).astype(kind) if kind else np.empty(0, np.uint8),
        "shape": np.array([n, low_bits], dtype=np.int64),
    }


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the ``rank``-th (from 0) one in each word: its byte by sums over all bytes at once, its bit from a table."""
    sums = word - ((word >> np.uint64(1)) & np.uint64(0x5555555555555555))
    sums = (sums & np.uint64(0x3333333333333333)) + ((sums >> np.uint64(2)) & np.uint64(0x3333333333333333))
    sums = ((sums + (sums >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _EACH  # ones up to and with each byte
    rank = rank.astype(np.uint64)
    shift = np.bitwise_count((rank * _EACH | _TOP) - sums & _TOP).astype(np.uint64) << np.uint64(3)
    rank -= (sums << np.uint64(8)) >> shift & np.uint64(255)
    byte = word >> shift & np.uint64(255)
    return (shift + _PLACES[(byte << np.uint64(3) | rank).view(np.int64)]).view(np.int64)


class Sequence:
    """Queries on the arrays of ``encode``."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.upper, self.ones, self.zeros, self.low = (arrays[k] for k in ("upper", "ones", "zeros", "low"))
        self.n, self.low_bits = (int(x) for x in arrays["shape"])

    def _select(self, rank: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the ``rank``-th one or zero bit."""
        before = self.ones if ones else self.zeros
        word = np.searchsorted(before, rank.astype(before.dtype), side="right") - 1
        bits = self.upper[word] if ones else ~self.upper[word]
        return word * 64 + _select_in_word(bits, rank - before[word])

    def _run(self, at: np.ndarray) -> np.ndarray:
        """Number of ones from bit ``at`` on, up to the next zero; a zero follows every one."""
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        bits = self.upper[word] >> shift  # zeros come in from the left
        length = np.bitwise_count(bits & ~(bits + np.uint64(1))).astype(np.int64)
        out = np.flatnonzero(length + (at & 63) == 64)  # goes on in the next word
        if len(out):
            before = at[out] - (self.ones[word[out]] + np.bitwise_count(
                self.upper[word[out]] & ((np.uint64(1) << shift[out]) - np.uint64(1))))  # zeros before the run
            length[out] = self._select(before, False) - at[out]
        return length

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i``."""
        high = self._select(i, True) - i
        return (high << self.low_bits) + (self.low[i].astype(np.int64) if self.low_bits else 0)

    def find(self, target: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """First place of each target within [lo, hi), or -1. The values there must ascend strictly."""
        found = np.full(len(target), -1, dtype=np.int64)
        if not self.n:
            return found
        high = target >> self.low_bits
        fits = np.flatnonzero((high + 1 < int(self.zeros[-1])) & (hi > lo))
        high = high[fits]
        after = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) + 1, 0)  # where its bucket starts
        begin = after - high
        end = begin + self._run(after)
        begin, end = np.maximum(begin, lo[fits]), np.minimum(end, hi[fits])
        if not self.low_bits:
            ok = begin < end
            found[fits[ok]] = begin[ok]
            return found
        inside = np.flatnonzero(begin < end)
        place, last, fits = begin[inside], end[inside] - 1, fits[inside]
        low = (target[fits] & ((1 << self.low_bits) - 1)).astype(self.low.dtype)
        open_ = np.flatnonzero(place < last)
        while len(open_):  # binary search in the low bits of one bucket
            mid = (place[open_] + last[open_]) >> 1
            less = self.low[mid] < low[open_]
            place[open_[less]] = mid[less] + 1
            last[open_[~less]] = mid[~less]
            open_ = open_[place[open_] < last[open_]]
        hit = np.flatnonzero(self.low[place] == low)
        found[fits[hit]] = place[hit]
        return found


class Level:
    """Children of a range of parents: monotone pointers, and child values made monotone by a running base."""

    @staticmethod
    def encode(parents: int, parent: np.ndarray, child: np.ndarray) -> dict[str, np.ndarray]:
        """Arrays of the pairs ``(parent, child)``, sorted and distinct, parents being 0..parents-1."""
        count = np.bincount(parent, minlength=parents)
        pointers = np.concatenate([[0], np.cumsum(count)])
        last = np.where(count > 0, child[np.maximum(pointers[1:] - 1, 0)] if len(child) else 0, 0)
        base = np.cumsum(last) - last
        return {f"p_{k}": v for k, v in encode(pointers).items()} | {
            f"v_{k}": v for k, v in encode(child + np.repeat(base, count)).items()
        }

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.pointers = Sequence({k[2:]: v for k, v in arrays.items() if k.startswith("p_")})
        self.values = Sequence({k[2:]: v for k, v in arrays.items() if k.startswith("v_")})

    def range(self, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both = self.pointers.access(np.concatenate([parent, parent + 1]))
        return both[:len(parent)], both[len(parent):]

    def find(self, parent: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each child (or -1), and place of its parent's first child. Equal parents that follow each other are read once."""
        own = np.flatnonzero(np.diff(parent, prepend=-1))
        back = np.repeat(np.arange(len(own)), np.diff(own, append=len(parent)))
        lo, hi = self.range(parent[own])
        base = np.zeros(len(lo), dtype=np.int64)
        later = np.flatnonzero((lo > 0) & (hi > lo))
        base[later] = self.values.access(lo[later] - 1)
        return self.values.find(base[back] + child, lo[back], hi[back]), lo[back]
