"""License scans: an exact set-similarity join between text blocks and license templates.

A block is a run of words, across lines too, at most as long as the template over ``share``; its set holds the distinct words. A
template is found where a block holds at least ``share`` of the template's distinct words, all of its telling words, and
none that names another license. Of overlapping blocks the best counts, the first of equal ones. Which templates a document
can hold at all is a join on the document's words. Tokens have one global order, rarest first, by the number of documents that hold them. With
``need`` = ceil(share x size), a block that holds ``need`` of a template's words holds one of its first
``size - need + 1``: only those are indexed (prefix filter). A set with fewer than ``need`` words of templates cannot
match (length filter), nor one in which too few words are left behind the shared one (positional filter). What is left
is counted exactly, so every block that meets the threshold is found.

Phrases are also looked for as such: places where their words stand consecutively, across lines too.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Mapping
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases with their labels, and templates (the statements by which works name their license).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "public-domain": "This work has been released into the public domain",
}
SHARE = (4, 5)  # a block must hold this part of a template's words
# Words that a block must hold (one of those between bars), and words of other licenses or denials that it must not hold.
TELLING = {
    "apache-2.0": ("apache 2|v2 0", ""),
    "bsd": ("redistribution source binary without modification permitted", "not"),
    "cc-by-nc-4.0": ("cc by nc 4 0", "sa nd"),
    "gpl-3.0": ("gnu general public license 3|v3", "lesser library affero"),
    "mit": ("mit license", ""),
    "mit-grant": ("permission granted obtaining copy this software", "organization"),
    "public-domain": ("released public domain", "not"),
}

_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LINES = bytes(10 if c == 10 else x for c, x in enumerate(_WORD))


def words(text: str | None) -> list[bytes]:
    """Words of a text: runs of 0-9, a-z and everything beyond ASCII, after lower-casing A-Z."""
    return (text or "").encode().translate(_WORD).split()


class Index:
    """Templates under one global token order, with the filters of the join."""

    def __init__(self, templates: Mapping[str, str], frequency: Mapping[bytes, int], share: tuple[int, int]):
        sets = {label: set(words(t)) for label, t in templates.items() if words(t)}
        vocabulary = sorted({w for own in sets.values() for w in own}, key=lambda w: (frequency.get(w, 0), w))
        self.order = {w: i for i, w in enumerate(vocabulary)}
        self.templates, self.prefix = [], {}
        for label, own in sorted(sets.items()):
            tokens = sorted(self.order[w] for w in own)
            need = -(-share[0] * len(tokens) // share[1])
            for place, token in enumerate(tokens[:len(tokens) - need + 1]):
                self.prefix.setdefault(token, []).append((len(self.templates), place))
            self.templates.append((label, len(tokens), need, frozenset(tokens)))
        self.probes = {vocabulary[t] for t in self.prefix}

    def matches(self, block: set[bytes]) -> dict[str, float]:
        """Templates that a block meets, with the part of their words that it holds."""
        tokens = sorted(self.order[w] for w in block if w in self.order)
        seen, found = set(), {}
        for at, token in enumerate(tokens):
            for number, place in self.prefix.get(token, ()):
                label, size, need, own = self.templates[number]
                if number in seen or len(tokens) < need or min(size - place, len(tokens) - at) < need - place:
                    continue
                seen.add(number)
                shared = sum(t in own for t in tokens)
                if shared >= need:
                    found[label] = shared / size
        return found


class Windows:
    """The blocks of one template in a list of words."""

    def __init__(self, template: str, telling: tuple[str, str], share: tuple[int, int]):
        every = words(template)
        self.own, self.length = frozenset(every), -(-share[1] * len(every) // share[0])
        self.need = -(-share[0] * len(self.own) // share[1])
        self.must = [frozenset(words(group.replace("|", " "))) for group in telling[0].split()]
        self.rivals = frozenset(words(telling[1]))
        self.seen = self.own.union(self.rivals, *self.must)

    def blocks(self, own: list[bytes]) -> list[tuple[int, float]]:
        """First word and part of the template's words of each block."""
        found: list[tuple[int, int, float]] = []
        held, hits, first = Counter(), [], 0  # words of the window hits[first:]
        for at, word in enumerate(own):
            if word not in self.seen:
                continue
            if word in self.rivals:
                held, hits, first = Counter(), [], 0
                continue
            hits.append((at, word))
            held[word] += 1
            while hits[first][0] <= at - self.length or held[hits[first][1]] > 1:  # too far back, or held again
                held[hits[first][1]] -= 1
                first += 1
            shared = sum(held[w] > 0 for w in self.own)
            if shared < self.need or not all(any(held[w] for w in group) for group in self.must):
                continue
            start, part = hits[first][0], shared / len(self.own)
            if not found or start > found[-1][1]:
                found.append((start, at, part))
            elif part > found[-1][2]:
                found[-1] = start, at, part
        return [(start, part) for start, _, part in found]


def _frequencies(vocabulary: frozenset[bytes]):
    def run(batches):
        held = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(vocabulary.intersection(words(text)))
        yield pa.RecordBatch.from_pydict({"token": pa.array(list(held), type=pa.binary()), "n": pa.array(list(held.values()), type=pa.int64())})

    return run


def _scanned(index: Index, windows: Mapping[str, Windows], phrases: Mapping[str, str]):
    sought = [(words(p), label) for p, label in phrases.items()]

    def places(own: list[bytes], phrase: list[bytes]) -> list[int]:
        found, at = [], -1
        for _ in range(own.count(phrase[0])):
            at = own.index(phrase[0], at + 1)
            if own[at:at + len(phrase)] == phrase:
                found.append(at)
        return found

    def run(batches):
        kind = pa.list_(pa.struct([("label", pa.string()), ("line", pa.int64()), ("share", pa.float64())]))
        spot = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
        for batch in batches:
            counts, bases, blocks = [], [], []
            for text in batch.column(1).to_pylist():
                own = words(text)
                held = set(own)
                counts.append(len(own))
                bases.append([{"label": label, "word": at} for phrase, label in sought
                              if held.issuperset(phrase) for at in places(own, phrase)])
                met = []
                if not held.isdisjoint(index.probes) and (possible := index.matches(held)):
                    if any(found := [windows[label].blocks(own) for label in possible]):
                        lines = text.encode().translate(_LINES).split(b"\n")
                        ends = list(accumulate(len(line.split()) for line in lines))  # words up to each line's end
                        met = [{"label": label, "line": bisect_right(ends, start), "share": part}
                               for label, starts in zip(possible, found) for start, part in starts]
                blocks.append(met)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, type=pa.int64()), pa.array(bases, type=spot), pa.array(blocks, type=kind)],
                names=["doc_id", "n_words", "places", "blocks"],
            )

    return run


def scan(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, str] = TEMPLATES,
         share: tuple[int, int] = SHARE, telling: Mapping[str, tuple[str, str]] = TELLING) -> DataFrame:
    """``docs(doc_id long, text)`` -> per row ``doc_id, n_words, places, blocks``.

    ``places`` lists every place of a phrase (label, word from 0), ``blocks`` every block that meets a template (label,
    line of its first word from 0, part of the template's words). Templates without ``telling`` words need none. Null counts as empty text. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    vocabulary = frozenset(w for t in templates.values() for w in words(t))
    counted = texts.select("text").mapInArrow(_frequencies(vocabulary), "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
    frequency = {bytes(r.token): r.n for r in counted.collect()}  # at most the templates' words
    windows = {label: Windows(t, telling.get(label, ("", "")), share) for label, t in templates.items()}
    return texts.mapInArrow(
        _scanned(Index(templates, frequency, share), windows, phrases),
        "doc_id long, n_words long, places array<struct<label:string,word:long>>, "
        "blocks array<struct<label:string,line:long,share:double>>",
    )
