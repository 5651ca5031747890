"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded words.

Folding lower-cases, maps homoglyphs to Latin letters and, in words that have letters, digits and signs to the letters
they stand for. A word with ``1`` or ``!`` (i or l) or with signs at its ends (letters or punctuation) has several
readings: an entry counts if any of them meets it, unless a reading that begins like the entry is an exception. In
training such a word counts once for each of at most eight readings, see ``readings``. A lexicon entry is the beginning of a word or a whole word; its weight is the log ratio of how often
toxic and other labelled training documents hold it. Words that begin like an entry but are themselves clean in the
training documents are exceptions, as are the phrases that a caller names: an entry inside one doesn't count. A
document's evidence is the sum of the weights of its matches over the square root of its number of words; one logistic
curve, fitted to the training documents, turns it into a score.

All training documents are counted. What comes to the driver is bounded: ``ENTRIES`` entries, ``EXCEPTIONS`` exceptions,
and the evidence of the training documents as a histogram of ``BINS`` cells per label.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.runtime import cut, discard

ENTRIES, EXCEPTIONS, BINS = 2_000, 2_000, 400
SHORTEST, LONGEST = 4, 12  # letters of an entry that is the beginning of a word
LEAST_TOXIC = 3  # documents that must hold an entry
LEAST_WEIGHT = 2.0

# Letters of other scripts that look like Latin ones, and what digits and signs stand for in words.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g",
}
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}
EITHER = {"1": "il", "!": "il"}
SIGNS = "@$!"

_FOLD = {ord(k): v for k, v in HOMOGLYPHS.items()} | {0xFF41 + i: chr(97 + i) for i in range(26)} | {ord("_"): " "}
_LEET = {ord(k): v for k, v in LEET.items()}
_SURE = {ord(k): v for k, v in LEET.items() if k not in EITHER}
_LETTERS = LEET | EITHER
_TOKEN = re.compile(r"[\w@$!]+")
_SIGNS = re.compile(r"[0-9@$!]")
_DOUBT = re.compile(r"(?<= )[^ 1@$!]*[1@$!][^ ]*")


def folded(text: str | None) -> list[str]:
    """Folded words of a text; what has several readings (``EITHER``, signs at the ends) stays. Null counts as empty."""
    words = []
    for word in _TOKEN.findall((text or "").lower().translate(_FOLD)):
        if _SIGNS.search(word):
            core = word.strip(SIGNS)
            if not core:
                continue
            if core.isdigit():
                word = core
            else:
                head, tail = _ends(word)
                word = word[:head] + core.translate(_SURE) + word[tail:]
        words.append(word)
    return words


def _ends(word: str) -> tuple[int, int]:
    """Where a word's first sign-free place is, and where its signs at the end begin."""
    return len(word) - len(word.lstrip(SIGNS)), len(word.rstrip(SIGNS))


def readings(word: str) -> set[str]:
    """Readings by which training documents count a folded word: ``EITHER`` as i or as l throughout, with and without
    the signs at its ends; ``!`` at the end is punctuation here."""
    if word.isdigit() or not _DOUBT.match(f" {word}", 1):
        return {word}
    word = word.rstrip("!")
    head, tail = _ends(word)
    found = {word[lo:hi] for lo in (0, head) for hi in (tail, len(word))}
    return {w.translate(_LEET | {ord(k): v[at] for k, v in EITHER.items()}) for w in found for at in (0, 1)}


def reads_as(word: str, plain: str) -> bool:
    """Whether a folded word has the reading ``plain``."""
    if word == plain or word.isdigit():
        return word == plain
    head, tail = _ends(word)
    return any(
        all(b in _LETTERS.get(a, a) for a, b in zip(word[lo:lo + len(plain)], plain))
        for lo in range(max(0, tail - len(plain)), min(head, len(word) - len(plain)) + 1)
    )


@dataclass
class Lexicon:
    """Entries (`` begin`` or `` word ``, with spaces as word ends) and their weights; exceptions with weight 0."""

    entries: dict[str, float]
    exceptions: list[str]
    slope: float = 1.0
    offset: float = 0.0
    _machine: object = field(default=None, repr=False)
    _begun: set[str] = field(default=None, repr=False)
    _around: dict[str, list[tuple[list[str], int]]] = field(default=None, repr=False)

    def machine(self):
        if self._machine is None:
            self._machine = ahocorasick.Automaton()
            for entry, weight in self.entries.items():
                self._machine.add_word(entry, (len(entry), weight))
            for phrase in self.exceptions:
                self._machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
            self._machine.make_automaton()
            self._begun = {e[:k] for e in self.entries for k in range(1, len(e) + 1)}
            self._around = {}
            for phrase in self.exceptions:
                own = phrase.split(" ")
                for at, word in enumerate(own):
                    whole = f" {word} "
                    for entry in {whole[:k] for k in range(1, len(whole) + 1)} & self.entries.keys():
                        self._around.setdefault(entry, []).append((own, at))
        return self._machine

    def met(self, word: str) -> set[str]:
        """Entries that some reading of a folded word meets; what is followed shrinks to beginnings of entries."""
        found, (head, tail) = set(), _ends(word)
        for lo in range(head + 1):
            states = {" "} & self._begun
            for at in range(lo, len(word) + 1):
                found |= states & self.entries.keys()
                if at >= tail:
                    found |= {s + " " for s in states} & self.entries.keys()
                if at == len(word) or not states:
                    break
                states = {s + c for s in states for c in _LETTERS.get(word[at], word[at])} & self._begun
        return found

    def excused(self, words: list[str], at: int, entry: str, least: int) -> bool:
        """Whether an entry met by the word at ``at`` lies in an exception, of ``least`` words on, that the words there
        can be read as."""
        for own, k in self._around.get(entry, ()):
            if len(own) < least:
                continue
            lo = at - k
            if lo >= 0 and lo + len(own) <= len(words) and all(map(reads_as, words[lo:lo + len(own)], own)):
                return True
        return False

    def evidence(self, words: list[str]) -> float:
        """Sum of the best weight per word start, without matches inside exceptions, by length."""
        if not words or not (self.entries or self.exceptions):
            return 0.0
        machine, text = self.machine(), f" {' '.join(words)} "
        doubtful = {m.start() - 1: m.group() for m in _DOUBT.finditer(text) if not m.group().isdigit()}
        met: dict[int, dict[str, float]] = {}
        clean: list[tuple[int, int]] = []
        for end, (size, weight) in machine.iter(text):
            start = end - size + 1
            if weight is None:
                clean.append((start, end))
            elif start not in doubtful:
                met.setdefault(start, {})[text[start:end + 1]] = weight
        starts = sorted(met)
        for lo, hi in clean:
            for start in starts[bisect_left(starts, lo):bisect_left(starts, hi)]:
                met.pop(start, None)
        for start, word in doubtful.items():
            if own := self.met(word):
                met[start] = {entry: self.entries[entry] for entry in own}
        if doubtful and self._around:
            place = dict(zip(accumulate((len(w) + 1 for w in words), initial=0), range(len(words))))
            for start, own in met.items():
                at = place[start]
                met[start] = {e: w for e, w in own.items() if not self.excused(words, at, e, 1 if start in doubtful else 2)}
        return sum(max(own.values(), default=0.0) for own in met.values()) / math.sqrt(len(words))

    def __getstate__(self):
        return self.__dict__ | {"_machine": None, "_begun": None, "_around": None}


def _counted(batches):
    """Training documents -> how many toxic and other ones hold each folded word, summed per batch."""
    for batch in batches:
        held = Counter(), Counter()
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held[toxic].update({r for w in set(folded(text)) for r in readings(w)})
        words = list(held[0].keys() | held[1].keys())
        yield pa.RecordBatch.from_pydict({
            "word": pa.array(words, type=pa.string()), "toxic": pa.array([held[1][w] for w in words], type=pa.int64()),
            "other": pa.array([held[0][w] for w in words], type=pa.int64()),
        })


def _evidence(lexicon: Lexicon, column: int):
    def run(batches):
        for batch in batches:
            found = [lexicon.evidence(folded(t)) for t in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, type=pa.float64())], names=[*batch.schema.names, "_evidence"]
            )

    return run


def evidence(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with ``_evidence`` of each whole ``text``; a column of that name is replaced."""
    docs = docs.drop("_evidence")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(_evidence(lexicon, docs.columns.index("text")), f"{kinds}, _evidence double")


def _fit(x: np.ndarray, toxic: np.ndarray, other: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve for weighted points, with a small ridge on the slope."""
    w, total = np.zeros(2), toxic + other
    rows = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -50, 50)))
        gradient = rows.T @ (toxic - total * p) - np.array([1e-2, 1e-6]) * w
        hessian = (rows * (total * p * (1 - p))[:, None]).T @ rows + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def learn(train: DataFrame, phrases: Sequence[str] = ()) -> Lexicon:
    """A lexicon from ``train(text, toxic 0/1)``; ``phrases`` are exceptions besides the learned ones."""
    words = cut(train.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        _counted, "word string, toxic long, other long"
    ).groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    n = train.agg(F.sum(F.col("toxic").cast("long")), F.count(F.lit(1))).first()
    toxic, other = n[0] or 0, n[1] - (n[0] or 0)
    size = F.length("word")
    begins = F.when(size >= SHORTEST, F.transform(
        F.sequence(F.lit(SHORTEST), F.least(size, F.lit(LONGEST))), lambda k: F.concat(F.lit(" "), F.substring("word", F.lit(1), k))
    )).otherwise(F.array().cast("array<string>"))
    terms = words.select(
        F.explode(F.concat(begins, F.array(F.concat(F.lit(" "), "word", F.lit(" "))))).alias("term"), "toxic", "other"
    ).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("other") + 0.5) / (other + 1.0))
    chosen = (
        terms.where(F.col("toxic") >= LEAST_TOXIC).withColumn("weight", weight).where(F.col("weight") >= LEAST_WEIGHT)
        .orderBy(F.desc(F.col("weight") * F.log1p("toxic")), F.length("term"), "term").limit(ENTRIES).collect()
    )
    entries: dict[str, float] = {}
    for row in sorted(chosen, key=lambda r: (len(r.term), r.term)):  # a longer entry must say more than a shorter one
        known = max((entries[row.term[:k]] for k in range(2, len(row.term)) if row.term[:k] in entries), default=0.0)
        if row.weight > known + 0.5:
            entries[row.term] = row.weight
    begun = sorted({e for e in entries if not e.endswith(" ")})
    exceptions = []
    if begun:
        stems = "^(" + "|".join(re.escape(e[1:]) for e in begun) + ")"
        exceptions = [r.word for r in (
            words.where(F.col("word").rlike(stems) & (F.col("other") >= LEAST_TOXIC) & (weight < 0))
            .orderBy(F.desc("other"), "word").limit(EXCEPTIONS).collect()
        )]
    discard(words)
    return Lexicon(entries, sorted({*exceptions, *(" ".join(folded(p)) for p in phrases)} - {""}))


def _fold(folds: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, phrases: Sequence[str] = ()) -> Lexicon:
    """A lexicon and its curve from the documents of ``labels(doc_id, toxic)`` outside the held-out fold.

    Held out are documents whose crc32 of doc_id as text is divisible by ``folds``. Null labels and labels of unknown
    documents count for nothing; of contradicting labels the toxic one counts. Without any labels the score is 0.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("toxic") != 0).cast("int")).alias("toxic")
    ).where(_fold(folds) != 0)
    train = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        known.hint("merge"), "doc_id").select("text", "toxic"))  # the same plan at every size
    lexicon = learn(train, phrases)
    cell = F.least(F.floor(F.col("_evidence") * 40), F.lit(BINS - 1)).alias("cell")
    bins = (
        evidence(train, lexicon).groupBy(cell)
        .agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"), F.avg("_evidence").alias("x")).collect()
    )
    discard(train)
    if bins:
        x, toxic, n = (np.array([r[c] for r in bins], dtype=float) for c in ("x", "toxic", "n"))
        lexicon.slope, lexicon.offset = _fit(x, toxic, n - toxic)
    else:
        lexicon.slope, lexicon.offset = 0.0, -50.0
    return lexicon


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from a half on); columns of these names are replaced."""
    docs = docs.drop("score", "predicted")
    z = F.col("_evidence") * lexicon.slope + lexicon.offset
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), z))))
    return (
        evidence(docs, lexicon).withColumn("score", score).drop("_evidence")
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    )


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, phrases: Sequence[str] = ()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text)``.

    Null and empty texts have evidence 0 and the score that belongs to it. A null doc_id is not held out. Rows that repeat
    a doc_id are scored each for itself; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = (F.coalesce(_fold(folds), F.lit(1)) == 0).alias("held_out")
    return scored(texts, fit(docs, labels, folds, phrases)).select("doc_id", held, "score", "predicted")
