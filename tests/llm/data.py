"""A small awkward table: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, chunk string, ids string, score string, rep string,"
    "_row string, length string, value string, id string, word string, part string"
)


def awkward():
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "Né", "tu", "ÄR") for b in ("", "ra", "st,", "x.", "ñ", "lo!")]
    text = lambda n: " ".join(rng.choices(words, k=n))
    passage, base = text(40), text(120)
    near = base.split()
    near[7] = "changed"
    rows = [
        (1, base), (2, " ".join(near)), (3, base.upper()), (4, None), (5, ""), (6, " \t\n "), (7, "one"), (8, "one"), (9, "One"),
        (10, text(30) + " " + passage), (11, text(20) + "\n" + passage + " " + text(9)), (12, passage.replace(" ", "\n", 3)),
        (13, text(9000)), (14, "a " * 700), (None, base), (None, None), (15, text(60)), (15, text(61)), (16, "x" * 20000),
        (17, "Licensed under the Apache License, Version 2.0.\nAll rights reserved. CC-BY all Rights RESERVED"),
        (18, "It's l'eau d'été; don’t <|endoftext|> 中文 text here 𝒳 ṡ̃ \x1c end"), (19, base), (19, base),
    ]
    return [(*r, *([None] * 6), *(["clash"] * 7)) for r in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
