"""Multi-round filling of quotas: plan the shortfall, ask a model, validate, de-duplicate, accept."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions import text as T
from plinth.operators import acceptance as AC
from plinth.operators import aggregates as A
from plinth.operators import model_map as MM
from plinth.operators import windows as W
from plinth.operators.ordering import ranked
from plinth.plans import dealing as DL
from plinth.plans import dimensions as D
from plinth.plans import quotas as Q
from plinth.runtime import cut

REPLY = (
    "samples array<struct<anchor_uid:string,anchor_name:string,anchor_description:string,"
    "placed_uid:string,placed_name:string,placed_description:string,placement:string>>"
)
ACCEPTED = (
    "seq long, category string, complexity string, context string, relation string, level string, anchor_uid string, "
    "placed_uid string, anchor_name string, placed_name string, placement string, k1 string, k2 string, k3 string"
)


class Filled(NamedTuple):
    """What a fill came to: scenes, what each kind still lacks (empty if all quotas are met), and what the calls cost."""

    scenes: DataFrame
    shortfall: DataFrame
    spend: DataFrame


def fill(pool: DataFrame, total: int, contexts: list[str], call, seed: str, rounds: int = D.FILL_ROUNDS,
         batch: int = D.SCENE_BATCH) -> DataFrame:
    """The scenes of ``fill_report``."""
    return fill_report(pool, total, contexts, call, seed, rounds, batch).scenes


def fill_report(pool: DataFrame, total: int, contexts: list[str], call, seed: str, rounds: int = D.FILL_ROUNDS,
                batch: int = D.SCENE_BATCH) -> Filled:
    """Accepted scenes toward quotas for ``total``; stops when nothing is short or ``rounds`` in a row brought no scene.

    Replies are written as they come, before anything is made of them, so a lost stage asks for none of them again. The driver only decides whether another round is needed. Each round is one set-oriented pass,
    and its accepted rows are written to the shared folder before the next. Rows past a quota are
    dropped within their round and reserve nothing afterwards.
    """
    spark = pool.sparkSession
    members = cut(DL.role_members(pool))
    sizes = cut(DL.bucket_sizes(members))
    deck = cut(DL.deck(members, seed))
    captions = pool.select("uid", "caption")
    quota = cut(Q.quotas(spark, total))
    accepted = spark.createDataFrame([], ACCEPTED)
    taken = spark.createDataFrame([], "role string, category string, taken long")
    spent = [spark.createDataFrame([], "calls int, cost double")]
    turn = fruitless = 0
    while fruitless < rounds:
        short = cut(Q.shortfall(quota, accepted).select("category", "complexity", "relations", "levels", "short"))
        plan = cut(DL.deal(short, sizes, contexts, f"{seed}/{turn}", batch))
        if plan.isEmpty():
            break
        requests = cut(DL.requests(plan, f"{seed}/{turn}"))
        offered = cut(DL.offers(requests, deck, taken))
        dealt_out = offered.groupBy("role", "category").agg(F.count(F.lit(1)).alias("taken"))
        taken = cut(taken.unionByName(dealt_out).groupBy("role", "category").agg(F.sum("taken").alias("taken")))
        lines = offered.join(captions, "uid").select(
            "request_id", "role", "pos", A.asset_line(F.col("uid"), F.col("caption")).alias("line")
        )
        avoid = W.recent_list(accepted, ["category", "context"], "seq", "placed_name", D.AVOID_PLACED, "avoid")
        prompts = A.request_prompt(plan, lines, avoid)
        answered = cut(MM.model_map(prompts, "request_id", "prompt", call, batch=1))
        spent.append(answered.select("calls", "cost"))
        replies = MM.parsed(answered, REPLY)
        scenes = replies.select("request_id", F.posexplode("data.samples").alias("i", "s")).select("request_id", F.col("i").cast("long").alias("i"), "s.*")
        role = lambda name: offered.where(F.col("role") == name).select(
            "request_id", F.col("uid").alias(f"{name}_uid"), F.lit(True).alias(f"{name}_offered"))
        known = lambda name: F.coalesce(f"{name}_offered", F.lit(False))
        dealt = plan.select("request_id", "i", "category", "complexity", "context", "relation", "level")
        joined = (
            scenes.join(dealt, ["request_id", "i"])
            .join(requests.select("request_id", "order_key"), "request_id")
            .join(role("anchor"), ["request_id", "anchor_uid"], "left")
            .join(role("placed"), ["request_id", "placed_uid"], "left")
        )
        valid = joined.where(AC.scene_problem(known("anchor"), F.lit(False), known("placed")).isNull())
        k1, k2 = AC.scene_keys()
        numbered = ranked(cut(valid), ["order_key", "request_id", "i"], out="seq")
        candidates = cut(numbered.select(
            (F.col("seq") + turn * (1 << 40)).alias("seq"), "category", "complexity", "context", "relation", "level",
            "anchor_uid", "placed_uid", "anchor_name", "placed_name", T.strip(F.col("placement")).alias("placement"),
            k1.alias("k1"), k2.alias("k2"), F.concat_ws("|", F.lit(str(turn)), "request_id", "anchor_uid").alias("k3"),
        ))
        fresh = AC.first_wins(candidates, ["k1", "k2", "k3"], "seq", accepted)
        remaining = short.select("category", "complexity", F.col("short").alias("remaining"))
        kept = AC.within_quota(cut(fresh), ["category", "complexity"], "seq", remaining)
        brought = cut(kept.select(*accepted.columns))
        fruitless = fruitless + 1 if brought.isEmpty() else 0
        accepted = cut(accepted.unionByName(brought))
        turn += 1
    short = Q.shortfall(quota, accepted).select("category", "complexity", "short").where("short > 0")
    return Filled(accepted, short, MM.spend(reduce(DataFrame.unionByName, spent)))
