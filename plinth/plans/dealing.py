"""Dealing: requests with round-robin relations, levels and contexts, and asset offers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions import text as T
from plinth.operators.ordering import Ordered, hash_ranked
from plinth.plans import dimensions as D

_BLOCK = 50_000


def numbered(df: DataFrame, count: Column, out: str) -> DataFrame:
    """``count`` rows per input row, numbered from 0.

    Numbers are generated in blocks that are spread over the cluster before they unfold, so one
    kind that lacks a billion samples is not unrolled inside one task.
    """
    blocks = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((count - 1) / _BLOCK)).cast("long")))
    spread = df.where(count > 0).withColumn("_count", count.cast("long")).withColumn("_block", blocks)
    spread = spread.repartition("_block")
    first = F.col("_block") * _BLOCK
    last = F.least(first + _BLOCK, F.col("_count")) - 1
    return spread.withColumn(out, F.explode(F.sequence(first, last))).drop("_block", "_count")


def seeded(seed: str, key: Column, modulus: Column) -> Column:
    """Seeded integer in [0, modulus)."""
    number = F.conv(F.substring(T.md5_order(seed, key), 1, 8), 16, 10).cast("long")
    return (number % modulus).cast("int")


def usable_pool(pool: DataFrame, licenses: list[str] | None = None) -> DataFrame:
    """Pool rows that may be offered; a missing license counts as ``unknown``."""
    kept = pool.where(~F.col("junk"))
    return kept.where(F.coalesce("license", F.lit("unknown")).isin(licenses)) if licenses else kept


def role_members(pool: DataFrame, licenses: list[str] | None = None) -> DataFrame:
    """Rows ``(role, category, uid)`` of usable assets; every usable asset anchors ``noncontact``."""
    anchors = F.array_distinct(F.array_append(F.coalesce("anchor", F.array().cast("array<string>")), F.lit("noncontact")))
    each = F.array(
        F.struct(F.lit("anchor").alias("role"), anchors.alias("ids")),
        F.struct(F.lit("placed").alias("role"), F.coalesce("placed", F.array().cast("array<string>")).alias("ids")),
    )
    rows = usable_pool(pool, licenses).select("uid", F.explode(each).alias("r"))
    return rows.select("uid", F.col("r.role").alias("role"), F.explode(F.array_distinct("r.ids")).alias("category"))


def bucket_sizes(members: DataFrame) -> DataFrame:
    """Assets per category and role (six rows)."""
    count = lambda role: F.count(F.when(F.col("role") == role, 1)).alias(f"{role}_size")
    return members.groupBy("category").agg(count("anchor"), count("placed"))


def deal(short: DataFrame, sizes: DataFrame, contexts: list[str], seed: str, batch: int = D.SCENE_BATCH) -> DataFrame:
    """One row per missing sample, grouped into requests of one kind.

    ``short(category, complexity, relations, levels, short)``. Slots of a kind are numbered
    through; relations, levels and contexts are dealt from that number, so no ordering window is
    needed. Contexts are shuffled per kind; kinds whose pool lacks a role are skipped.
    """
    kind = F.concat_ws("|", "category", "complexity")
    ready = short.join(F.broadcast(sizes), "category").where("anchor_size > 0 and placed_size > 0 and short > 0")
    deck = F.transform(
        F.array_sort(F.transform(
            F.array(*[F.lit(c) for c in contexts]),
            lambda c: F.struct(F.md5(F.concat(F.lit(f"{seed}:"), kind, F.lit("/"), c)).alias("k"), c.alias("c")),
        )),
        lambda s: s["c"],
    )
    width = F.least(F.lit(batch), F.col("anchor_size")).cast("long")
    prepared = ready.select(
        "category", "complexity", "relations", "levels", "short", "anchor_size", "placed_size",
        width.alias("width"), deck.alias("deck"),
        seeded(f"{seed}/relation", kind, F.size("relations")).alias("offset"),
        seeded(f"{seed}/level", kind, F.size("levels")).alias("level_offset"),
    )
    slots = numbered(prepared, F.col("short"), "slot")
    turn = F.floor(F.col("slot") / F.col("width"))
    at = lambda array, n: F.get(array, (n % F.size(array)).cast("int"))
    return slots.select(
        "category", "complexity", turn.alias("turn"),
        F.concat_ws("|", "category", "complexity", turn.cast("string")).alias("request_id"),
        "slot", (F.col("slot") % F.col("width")).alias("i"),
        at("deck", turn).alias("context"),
        at("relations", F.col("offset") + F.col("slot")).alias("relation"),
        at("levels", F.col("level_offset") + F.col("slot")).alias("level"),
        "anchor_size", "placed_size",
    )


def requests(plan: DataFrame, seed: str) -> DataFrame:
    """One row per request with its size and seeded position in the interleaved plan."""
    grouped = plan.groupBy("request_id", "category", "complexity", "turn", "context").agg(
        F.count(F.lit(1)).alias("n"), F.first("anchor_size").alias("anchor_size"),
        F.first("placed_size").alias("placed_size"),
    )
    return grouped.withColumn("order_key", T.md5_order(seed, F.col("request_id")))


def deck(members: DataFrame, seed: str) -> DataFrame:
    """Every role's assets of a category in seeded order, ranked from 0."""
    keyed = members.withColumn("_k", T.md5_order(seed, F.concat_ws("/", "role", "category", "uid")))
    ranked = hash_ranked(keyed, "_k", "uid", by=["role", "category"], out="_rn")
    return ranked.select("role", "category", "uid", (F.col("_rn") - 1).alias("rank"))


def offers(reqs: DataFrame, ranked_deck: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """Assets offered to each request: consecutive cards of the deck, wrapping, never repeating.

    Takes of one category continue where the previous take stopped, so usage counts of any two
    assets of a bucket differ by at most one wrap. The running start is an ``Ordered`` sum; cards
    are then fetched by an equi-join on (role, category, rank), which spreads evenly.
    ``taken(role, category, taken)`` continues after the cards of earlier rounds (twelve rows).
    """
    sized = reqs.select(
        "request_id", "category", "order_key",
        F.explode(F.array(
            F.struct(F.lit("anchor").alias("role"), F.least(2 * F.col("n"), F.col("anchor_size")).alias("k"), F.col("anchor_size").alias("size")),
            F.struct(F.lit("placed").alias("role"), F.least(F.lit(D.PLACED_OFFER), F.col("placed_size")).alias("k"), F.col("placed_size").alias("size")),
        )).alias("t"),
    ).select("request_id", "category", "order_key", "t.*")
    started = Ordered(sized, ["order_key", "request_id"], by=["role", "category"]).running_sum("k", "upto").done()
    cards = started.withColumn("pos", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
    before = F.lit(0)
    if taken is not None:
        cards = cards.join(F.broadcast(taken), ["role", "category"], "left")
        before = F.coalesce("taken", F.lit(0))
    rank = (before + F.col("upto") - F.col("k") + F.col("pos")) % F.col("size")
    return cards.select("request_id", "role", "category", "pos", rank.alias("rank")).join(
        ranked_deck, ["role", "category", "rank"]
    )


def context_requests(total: DataFrame, contexts: list[str], phrasings: list[str], seed: str,
                     batch: int = D.SCENE_BATCH) -> DataFrame:
    """The flat plan: ``total`` spread evenly over shuffled contexts, phrasings dealt in turn.

    ``total`` is one row with a ``total`` column. The number of requests per context is known in
    closed form, so each context's first turn is a sum over at most ``len(contexts)`` rows.
    """
    n = len(contexts)
    shuffled = F.array_sort(F.array(*[
        F.struct(F.md5(F.lit(f"{seed}:{c}")).alias("k"), F.lit(c).alias("context")) for c in contexts
    ]))
    base = total.select(F.col("total").cast("long").alias("total"), F.posexplode(shuffled).alias("i", "s"))
    share = F.floor(F.col("total") / n) + F.when(F.col("i") < F.col("total") % n, 1).otherwise(0)
    sized = base.select("total", "i", F.col("s.context").alias("context"), share.alias("share")).withColumn(
        "parts", F.ceil(F.col("share") / batch)
    )
    # Contexts with the larger share come first, so the turns before context i are two products.
    large = F.floor(F.col("total") / n) + 1
    small = F.floor(F.col("total") / n)
    heavy = F.col("total") % n
    before = F.least(F.col("i").cast("long"), heavy) * F.ceil(large / batch) + F.greatest(
        F.lit(0), F.col("i") - heavy
    ) * F.ceil(small / batch)
    turns = numbered(sized.withColumn("before", before), F.col("parts"), "part")
    ordinal = F.col("before") + F.col("part")
    words = F.array(*[F.lit(p) for p in phrasings])
    offset = seeded(f"{seed}/phrasing", F.lit("start"), F.lit(len(phrasings)))
    return turns.select(
        ordinal.alias("turn"), "context",
        F.least(F.lit(batch), F.col("share") - F.col("part") * batch).alias("count"),
        F.get(words, ((ordinal + offset) % len(phrasings)).cast("int")).alias("phrasing"),
    )
