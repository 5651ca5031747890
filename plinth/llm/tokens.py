"""Token ids of whole texts by a tokenizer file whose pre-tokens never span white space.

Such a tokenizer gives every run between spaces or line feeds its ids on its own, so each distinct run is encoded once
per worker, by the ``tokenizers`` library, and documents are put together from the ids of their runs.

The tokenizer also lower-cases and separates letters from everything but an apostrophe. A text of Latin-1 characters
without apostrophes and special tokens can therefore be lower-cased and cut at each end of a run of letters, which leaves far fewer
distinct runs. Other texts are cut at spaces and line feeds only.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

CACHED_RUNS = 600_000  # forgotten all at once when there are more; bounds memory, never results
TEXT_RUNS = 5_000  # distinct runs handed to the library as one text

_LETTERS = rb"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_PIECES = re.compile(rb"[" + _LETTERS + rb"]+|[^ \n" + _LETTERS + rb"]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 or 192 <= c <= 222 and c != 215 else c for c in range(256))


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str | bytes, bytes] = {}

    def encode(self, texts: list[str | None], end: int) -> list[bytes]:
        """Ids of each text and ``end``, as little-endian unsigned 32-bit integers; null counts as empty."""
        tail = np.array([end], dtype="<u4").tobytes()
        if len(self.known) > CACHED_RUNS:
            self.known.clear()
        split = [self._split(t) for t in texts]
        seen: set[str | bytes] = set()
        for own in split:
            seen.update(own)
        self._learn(list(seen.difference(self.known)))
        get = self.known.__getitem__
        return [b"".join(map(get, own)) + tail for own in split]

    @staticmethod
    def _split(text: str | None) -> list[str] | list[bytes]:
        if not text:
            return []
        if "'" not in text and "<|" not in text:
            try:
                return _PIECES.findall(text.encode("latin-1").translate(_LOWER))
            except UnicodeEncodeError:
                pass
        return text.replace("\n", " ").split(" ")

    def _learn(self, new: list[str | bytes]) -> None:
        for lo in range(0, len(new), TEXT_RUNS):
            some = new[lo:lo + TEXT_RUNS]
            runs = [r if isinstance(r, str) else r.decode("latin-1") for r in some]
            found = self.tokenizer.encode(" ".join(runs), add_special_tokens=False)
            raw = np.array(found.ids, dtype="<u4").tobytes()
            begin = np.array([a for a, _ in found.offsets], dtype=np.int64)
            ends = np.cumsum([len(r) + 1 for r in runs])
            cuts = (4 * np.searchsorted(begin, ends, side="left")).tolist()
            self.known.update(zip(some, (raw[a:b] for a, b in zip([0, *cuts], cuts))))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)
