"""Fill-in-middle: documents cut into prefix, middle and suffix at unit boundaries and written in another order.

A unit is a word with the white space before it, or white space at the end. One ``fullmatch`` of the repeated unit covers a
text; the ``regex`` library keeps every repetition of the group, so ``ends(1)`` holds the number of units and the place of
every cut at once. Where and how a document is cut depends on its doc_id and the seed only, so a retried task gives the same.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# The quantifiers keep what they took: no text can make the match go back.
UNITS = regex.compile(r"([\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)*+")
BATCH_CHARS = 1 << 20
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit integers of a document: the first digits of a digest of seed and doc_id (null: no digits)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def transform(text: str, h: list[int], share: int, suffix_first: int) -> tuple:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= share:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (ends[k - 1] if k else 0 for k in (low, high))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _transformed(seed: int, share: int, suffix_first: int):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            rows, chars = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                key, whole = doc_id.as_py(), text.as_py() or ""
                rows.append((key, *transform(whole, draws(key, seed), share, suffix_first)))
                chars += len(whole)
                if chars >= BATCH_CHARS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows, chars = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


def fill_in_middle(docs: DataFrame, seed: int = 42, share: int = 50, suffix_first: int = 80) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per row: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``share`` of 100 documents change; of those ``suffix_first`` of 100 put the suffix first (``spm``), the others the
    prefix (``psm``). Empty texts, and those that hold a marker, stay ``plain`` with null lengths. A null text counts as
    empty, a null doc_id draws by an empty key, repeated rows are ordinary rows, other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_transformed(seed, share, suffix_first), SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that a row was made from. Each marker stands once in a changed output, so the parts lie between them."""
    between = lambda a, b: F.substring_index(F.substring_index(output, a, -1), b, 1)
    middle = F.substring_index(output, MIDDLE, -1)
    return (
        F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
        .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
        .otherwise(output)
    )
