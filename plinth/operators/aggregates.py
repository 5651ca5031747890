"""Summaries, audits and prompt texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions import text as T
from plinth.plans import dimensions as D
from plinth.plans.quotas import kind_of

CAPTION_IN_TAGS, CAPTION_IN_OFFERS = 240, 220
EPS = 1e-9


def license_histogram(assets: DataFrame) -> DataFrame:
    return assets.groupBy(F.coalesce("license", F.lit("unknown")).alias("license")).agg(F.count(F.lit(1)).alias("assets"))


def pool_summary(spark: SparkSession, pool: DataFrame) -> DataFrame:
    """Assets, junk, anchors and placed per category; every category appears, zeroes included.

    Membership is counted by conditional sums in one pass, so the pool is never exploded.
    """
    count = lambda c, role: F.count(F.when(F.array_contains(role, c), 1))
    one = pool.agg(
        F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("junk"), 1)).alias("junk"),
        F.array(*[
            F.struct(F.lit(c).alias("category"), count(c, "anchor").alias("anchors"), count(c, "placed").alias("placed"))
            for c in D.CATEGORY_IDS
        ]).alias("r"),
    )
    return one.select("total", "junk", F.explode("r").alias("r")).select("total", "junk", "r.*")


def category_matrix(samples: DataFrame) -> DataFrame:
    """Category x complexity counts with totals: rows per category plus ``all``."""
    kind = samples.select("category", kind_of(F.col("complexity")).alias("kind"))
    cell = lambda k: F.count(F.when(F.col("kind") == k, 1)).alias(k)
    rolled = kind.rollup("category").agg(cell("simple"), cell("complex"), F.count(F.lit(1)).alias("total"))
    return rolled.withColumn("category", F.coalesce("category", F.lit("all")))


def axis_ratios(sizes: DataFrame, columns: list[str]) -> DataFrame:
    """Rounded dimensions and their ratios to the longest side."""
    longest = F.greatest(*columns, F.lit(EPS))
    return sizes.withColumns(
        {**{c: T.fixed(F.col(c)) for c in columns}, **{f"{c}_ratio": T.fixed(F.col(c) / longest) for c in columns}}
    )


def dimension_ratio(a: Column, b: Column) -> Column:
    return T.fixed(a / F.greatest(b, F.lit(EPS)))


def scale_audit(pairs: DataFrame) -> DataFrame:
    """World sizes and their ratio: ``world = raw * scale``, placed over anchor.

    The ratio comes from the world sizes, because a rounded scale can print as zero.
    """
    world = pairs.withColumns({"a_world": F.col("a_raw"), "b_world": F.col("b_raw") * F.col("scale")})
    return world.withColumn("ratio", F.col("b_world") / F.greatest(F.col("a_world"), F.lit(EPS)))


def audit_summary(audit: DataFrame, outlier: float) -> DataFrame:
    """Exact median, extremes and outlier count of the ratio per category.

    ``percentile`` keeps one counter per distinct value, so the ratio is rounded to three digits
    first: its state is bounded by the value range and not by the row count.
    """
    r = F.round("ratio", 3)
    return audit.withColumn("ratio", r).groupBy("category").agg(
        F.count(F.lit(1)).alias("samples"), F.percentile("ratio", 0.5).alias("median"),
        F.min("ratio").alias("least"), F.max("ratio").alias("most"),
        F.count(F.when(F.col("ratio") > outlier, 1)).alias("outliers"),
    )


def next_id(names: DataFrame, name: str, prefix: str) -> DataFrame:
    """The next free zero-padded id after the largest numeric suffix; 1 when there is none."""
    number = F.expr(f"try_cast(nullif(regexp_extract({name}, '^{prefix}([0-9]+)$', 1), '') as bigint)")
    return names.agg((F.coalesce(F.max(number), F.lit(0)) + 1).alias("n")).select(T.pad_id(F.col("n"), 4, prefix).alias("next_id"))


def numbered_captions(rows: DataFrame, batch: str, i: str, caption: str) -> DataFrame:
    """Tagging prompt per batch: numbered captions, cut at 240 characters (a batch is bounded)."""
    line = F.concat(F.col(i).cast("string"), F.lit(". "), F.substring(caption, 1, CAPTION_IN_TAGS))
    items = F.array_sort(F.collect_list(F.struct(F.col(i).alias("i"), line.alias("line"))))
    return rows.groupBy(batch).agg(items.alias("l")).select(batch, F.array_join("l.line", "\n").alias("prompt"))


def asset_line(uid: Column, caption: Column) -> Column:
    return F.concat(F.lit("- "), uid, F.lit(" — "), F.substring(caption, 1, CAPTION_IN_OFFERS))


def request_prompt(plan: DataFrame, offer_lines: DataFrame, avoid: DataFrame | None = None) -> DataFrame:
    """Scene prompt per request: setting, numbered relations with detail levels, offered assets.

    ``offer_lines(request_id, role, pos, line)``; both lists are bounded by the batch size.
    """
    level = F.lit(None).cast("string")
    for name, text in D.LEVEL_TEXT.items():
        level = F.when(F.col("level") == name, text).otherwise(level)
    line = F.concat((F.col("i") + 1).cast("string"), F.lit(". "), "relation", F.lit(" — "), level)
    asked = plan.groupBy("request_id", "category", "context").agg(
        F.array_sort(F.collect_list(F.struct("i", line.alias("line")))).alias("r")
    ).select("request_id", "category", "context", F.size("r").alias("n"), F.array_join("r.line", "\n").alias("relations"))
    listed = lambda role: F.array_join(F.transform(
        F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("pos", "line")))), lambda s: s["line"]), "\n").alias(role)
    offered = offer_lines.groupBy("request_id").agg(listed("anchor"), listed("placed"))
    joined = asked.join(offered, "request_id")
    tail = F.lit("")
    if avoid is not None:
        joined = joined.join(avoid, ["category", "context"], "left")
        tail = F.when(F.col("avoid").isNotNull(), F.concat(
            F.lit("\n\nObjects this setting has had enough of: "), "avoid")).otherwise("")
    prompt = F.concat(
        F.lit("Write "), F.col("n").cast("string"), F.lit(" scene(s) for this setting: "), "context", F.lit("\n\n"),
        F.lit("Relations, scene by scene:\n"), "relations",
        F.lit("\n\nAnchors on offer (never twice):\n"), "anchor",
        F.lit("\n\nObjects to place on offer (may repeat):\n"), "placed", tail,
    )
    return joined.select("request_id", prompt.alias("prompt"))


def block_text(blocks: DataFrame) -> DataFrame:
    """One line per block in rank order, joined per mesh (a mesh has at most a grid of blocks)."""
    number = lambda c: T.plain_number(F.col(c), 6)
    corner = lambda k: F.concat(F.lit("("), F.concat_ws(", ", *[number(f"{a}{k}") for a in "xyz"]), F.lit(")"))
    line = F.concat(corner(0), F.lit(" to "), corner(1))
    items = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    return blocks.groupBy("mesh_id").agg(items.alias("l")).select("mesh_id", F.array_join("l.line", "\n").alias("text"))


def mesh_text(headers: DataFrame, texts: DataFrame, counts: DataFrame) -> DataFrame:
    """What a prompt says of a mesh, ``mesh_id, about``: its size to four decimals, how many blocks it has, and their list."""
    number = lambda c: T.plain_number(F.round(F.col(c), 4), 4)
    size = F.concat_ws(" by ", *[number(f"size{a}") for a in "xyz"])
    joined = headers.join(counts, "mesh_id").join(texts, "mesh_id")
    return joined.select("mesh_id", F.concat(
        F.lit("Size "), size, F.lit(" along x, y and z, middle at the origin; blocks by volume: "), F.col("blocks").cast("string"), F.lit("\n"), "text",
    ).alias("about"))


def placement_prompt(phrase: Column, anchor_name: Column, anchor_about: Column, placed_name: Column, placed_about: Column) -> Column:
    """What a placement model reads: the phrase, the object that stays and the one to be put there."""
    return F.concat(
        F.lit('Phrase: "'), phrase, F.lit('"\n\nObject that stays — "'), anchor_name, F.lit('"\n'), anchor_about,
        F.lit('\n\nObject to be put there — "'), placed_name, F.lit('"\n'), placed_about,
    )
