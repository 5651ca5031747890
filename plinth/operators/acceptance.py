"""Deciding which generated rows to keep: validity, duplicates, quotas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions import text as T
from plinth.operators.ordering import Ordered
from plinth.plans import dimensions as D
from plinth.runtime import cut


def scene_problem(anchor_offered: Column, anchor_reused: Column, placed_offered: Column) -> Column:
    """First reason a generated scene is unusable, or null. Order of the tests matters."""
    anchor, placed = F.col("anchor_name"), F.col("placed_name")
    phrase = T.strip(F.coalesce("placement", F.lit("")))
    lower = F.lower(phrase)
    styles = F.array(*[F.lit(w) for w in D.STYLE_WORDS])

    def bad_length(name: Column) -> Column:
        return ~T.word_count(F.coalesce(name, F.lit(""))).between(1, 3)

    def styled(name: Column) -> Column:
        w = T.words(F.lower(name))
        return (F.size(w) > 1) & F.arrays_overlap(w, styles)

    def empty(text: Column) -> Column:
        return F.coalesce(T.strip(text), F.lit("")) == ""

    bare = F.replace(F.replace(lower, F.lower(anchor), F.lit(" ")), F.lower(placed), F.lit(" "))
    tests = [
        (~anchor_offered, "anchor not offered"),
        (anchor_reused, "anchor reused"),
        (~placed_offered, "placed not offered"),
        (bad_length(anchor), "bad anchor name"),
        (styled(anchor), "styled anchor name"),
        (bad_length(placed), "bad placed name"),
        (styled(placed), "styled placed name"),
        (empty(F.col("anchor_description")) | empty(F.col("placed_description")), "empty description"),
        (T.word_count(phrase) > D.PHRASE_MAX_WORDS, "phrase too long"),
        (~F.contains(lower, F.concat(F.lit("the "), F.lower(anchor))), "anchor without article"),
        (~F.contains(lower, F.lower(placed)), "placed object missing"),
        (bare.rlike(r"\b(" + "|".join(D.FORCEFUL_STEMS) + ")"), "forceful verb"),
    ]
    return F.coalesce(*[F.when(test, reason) for test, reason in tests])


def scene_keys() -> list[Column]:
    """Duplicate keys of a scene: by seed asset, and by wording."""
    return [
        F.concat_ws("|", "category", "anchor_uid", T.slug(F.col("placed_name")), "relation"),
        F.concat_ws("|", T.slug(F.col("anchor_name")), T.slug(F.col("placed_name")), F.lower(T.strip(F.col("placement")))),
    ]


def first_by_key(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """First row of each key. Only the smallest ``seq`` per key and task is shuffled."""
    first = df.groupBy(*keys).agg(F.min(seq).alias(seq))
    return df.join(first.select(seq), seq, "left_semi")


def first_wins(df: DataFrame, keys: Sequence[str], seq: str, existing: DataFrame | None = None) -> DataFrame:
    """Accept a row unless an accepted earlier row (or ``existing``) shares any of its keys.

    Same result as the sequential loop, found by rounds: a row that is the earliest undecided one
    under every one of its keys is accepted; undecided rows sharing a key with an accepted row are
    rejected; repeat. A rejected row reserves nothing. Every round decides at least the earliest
    undecided row of each connected group, and hot keys are folded to one row (their minimum)
    before anything is joined on them. Key columns are non-null; ``existing`` has the same ones.
    """
    spark = df.sparkSession
    # Rows alike in all keys: only the first can ever be accepted.
    slim = df.groupBy(*keys).agg(F.min(seq).alias(seq))
    for key in keys if existing is not None else []:
        slim = slim.join(existing.select(key).distinct(), key, "left_anti")
    undecided = cut(slim)
    accepted: list[DataFrame] = []
    while not undecided.isEmpty():
        judged = undecided
        for n, key in enumerate(keys):
            least = undecided.groupBy(key).agg(F.min(seq).alias(f"_m{n}"))
            judged = judged.join(least, key)
        wins = reduce(lambda a, b: a & b, [F.col(f"_m{n}") == F.col(seq) for n in range(len(keys))])
        judged = cut(judged.select(seq, *keys, wins.alias("_win")))
        winners = judged.where("_win").select(seq, *keys)
        accepted.append(winners.select(seq))
        rest = judged.where(~F.col("_win")).select(seq, *keys)
        for key in keys:
            rest = rest.join(winners.select(key), key, "left_anti")
        undecided = cut(rest)
    chosen = reduce(DataFrame.unionByName, accepted) if accepted else spark.createDataFrame([], df.select(seq).schema)
    return df.join(chosen, seq, "left_semi")


def within_quota(df: DataFrame, by: Sequence[str], seq: str, remaining: DataFrame) -> DataFrame:
    """Earliest rows of each kind up to ``remaining(by..., remaining)``; kinds may be huge."""
    ranked = Ordered(df, [seq], by=by).row_number("_place").done()
    return ranked.join(remaining, list(by)).where(F.col("_place") <= F.col("remaining")).drop(
        "_place", "remaining"
    )
