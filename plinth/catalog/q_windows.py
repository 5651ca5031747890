"""Windowed rules (W), dealing, acceptance and model maps (M)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from plinth.catalog.q_aggregates import shortfalls
from plinth.catalog.q_rows import judged
from plinth.catalog.registry import query
from plinth.catalog.sqlviews import SQL_VIEWS, slug
from plinth.functions import text as T
from plinth.operators import acceptance as AC
from plinth.operators import aggregates as A
from plinth.operators import model_map as MM
from plinth.operators import windows as W
from plinth.operators.ordering import hash_ranked, ranked
from plinth.plans import dealing as DL
from plinth.plans import dimensions as D
from plinth.runtime import cut, large

SEED = "plan"
SETTINGS = ["kitchen", "garage", "coffee shop", "art studio", "fishing dock"]

_INT = lambda seed, key, n: f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT % ({n}))"
_KINDS = "(VALUES " + ", ".join(
    f"('{c[0]}', '{k}', [{', '.join(repr(r) for r in (c[2] if k == 'simple' else c[3]))}], [{', '.join(repr(v) for v in D.LEVELS[k])}])"
    for c in D.CATEGORIES for k in D.COMPLEXITIES
) + ") k(category, complexity, relations, levels)"
SQL_VIEWS["bucket_sizes"] = """
    SELECT category, count(*) FILTER (role = 'anchor') AS anchor_size, count(*) FILTER (role = 'placed') AS placed_size
    FROM members GROUP BY category"""
SQL_VIEWS["plan"] = f"""
    SELECT category, complexity, slot // width AS turn, category || '|' || complexity || '|' || (slot // width) AS request_id, slot, slot % width AS i,
       contexts[(slot // width) % len(contexts) + 1] AS context, relations[(relation_offset + slot) % len(relations) + 1] AS relation,
       levels[(level_offset + slot) % len(levels) + 1] AS level, anchor_size, placed_size
    FROM (
      SELECT category, complexity, relations, levels, anchor_size, placed_size, least(20, anchor_size) AS width, unnest(range(short)) AS slot,
        {_INT('plan/relation', "category || '|' || complexity", 'len(relations)')} AS relation_offset,
        {_INT('plan/level', "category || '|' || complexity", 'len(levels)')} AS level_offset,
        (SELECT list(c ORDER BY md5('plan:' || s.category || '|' || s.complexity || '/' || c), c) FROM (SELECT unnest({SETTINGS!r}) AS c)) AS contexts
      FROM shortfalls s JOIN {_KINDS} USING (category, complexity) JOIN bucket_sizes USING (category)
      WHERE anchor_size > 0 AND placed_size > 0 AND short > 0)"""
SQL_VIEWS["plan_requests"] = """
    SELECT request_id, category, complexity, turn, context, count(*) AS n, any_value(anchor_size) AS anchor_size,
       any_value(placed_size) AS placed_size, md5('plan:' || request_id) AS order_key FROM plan GROUP BY ALL"""
SQL_VIEWS["deck"] = """
    SELECT role, category, uid, row_number() OVER (PARTITION BY role, category ORDER BY md5('plan:' || role || '/' || category || '/' || uid), uid) - 1 AS rank
    FROM members"""
SQL_VIEWS["offer"] = """
    WITH t AS (SELECT request_id, category, order_key, 'anchor' AS role, least(2 * n, anchor_size) AS k, anchor_size AS size FROM plan_requests
               UNION ALL SELECT request_id, category, order_key, 'placed', least(30, placed_size), placed_size FROM plan_requests),
      s AS (SELECT *, sum(k) OVER (PARTITION BY role, category ORDER BY order_key, request_id) - k AS start FROM t),
      c AS (SELECT *, unnest(range(k)) AS pos FROM s)
    SELECT request_id, role, category, pos, uid FROM c JOIN deck USING (role, category) WHERE rank = (start + pos)::BIGINT % size"""


def plan(t):
    sizes = DL.bucket_sizes(DL.role_members(t.pool))
    return DL.deal(shortfalls(t).select("category", "complexity", "relations", "levels", "short"), sizes, SETTINGS, SEED)


def offer(t, requests):
    return DL.offers(requests, DL.deck(DL.role_members(t.pool), SEED))


@query("w1_deal_plan", "SELECT request_id, i, context, relation, level FROM plan")
def _(t):
    return plan(t).select("request_id", "i", "context", "relation", "level")


_TOTAL = "(SELECT count(*) AS total FROM documents)"


@query("w1_deal_contexts", f"""
    WITH s AS (SELECT total, context, row_number() OVER (ORDER BY md5('flat:' || context), context) - 1 AS idx
               FROM (SELECT unnest({SETTINGS!r}) AS context), {_TOTAL}),
      h AS (SELECT *, total // 5 + CASE WHEN idx < total % 5 THEN 1 ELSE 0 END AS share FROM s),
      p AS (SELECT *, unnest(range(ceil(share / 20)::BIGINT)) AS part FROM h),
      q AS (SELECT *, row_number() OVER (ORDER BY idx, part) - 1 AS turn FROM p)
    SELECT turn, context, least(20, share - part * 20) AS count,
      ['both', 'anchor', 'object', 'bare'][(turn + {_INT('flat/phrasing', "'start'", 4)}) % 4 + 1] AS phrasing FROM q""")
def _(t):
    total = t.documents.agg(F.count(F.lit(1)).alias("total"))
    return DL.context_requests(total, SETTINGS, D.PHRASINGS, "flat")


@query("w2_deck_offers", "SELECT request_id, role, pos, uid FROM offer")
def _(t):
    return offer(t, cut(DL.requests(plan(t), SEED))).select("request_id", "role", "pos", "uid")


@query("w3_batches", "SELECT doc_id, batch, i FROM tag_batches")
def _(t):
    return W.batches(t.documents.select("doc_id"), "doc_id", D.TAG_BATCH).select("doc_id", "batch", "i")


@query("w3_local_batches", "SELECT count(*) AS rows, true AS bounded FROM documents")
def _(t):
    rows = W.local_batches(t.documents.select("doc_id"), D.TAG_BATCH)
    return rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("rows"), (F.max("n") <= D.TAG_BATCH).alias("bounded"))


SQL_VIEWS["scene_keys"] = f"""
    SELECT seq, problem, category || '|' || anchor_uid || '|' || {slug('placed_name')} || '|' || relation AS k1,
       {slug('anchor_name')} || '|' || {slug('placed_name')} || '|' || lower(placement) AS k2 FROM judged"""


def keyed_scenes(t):
    k1, k2 = AC.scene_keys()
    return judged(t).where("problem is null").select("seq", "category", k1.alias("k1"), k2.alias("k2"))


@query("w4_first_by_one_key", "SELECT min(seq) AS seq, k2 FROM scene_keys WHERE problem IS NULL GROUP BY k2")
def _(t):
    return AC.first_by_key(keyed_scenes(t), ["k2"], "seq").select("seq", "k2")


_FRESH = "NOT list_contains(s1, o.k1) AND NOT list_contains(s2, o.k2)"


@query("w4_first_wins_two_keys", f"""
    WITH RECURSIVE o AS (SELECT seq, k1, k2, row_number() OVER (ORDER BY seq) AS rn FROM scene_keys WHERE problem IS NULL),
      walk AS (
        SELECT 0::BIGINT AS rn, NULL::BIGINT AS seq, NULL::VARCHAR AS k1, NULL::VARCHAR AS k2, false AS ok, []::VARCHAR[] AS s1, []::VARCHAR[] AS s2
        UNION ALL
        SELECT o.rn, o.seq, o.k1, o.k2, {_FRESH}, CASE WHEN {_FRESH} THEN list_append(s1, o.k1) ELSE s1 END,
          CASE WHEN {_FRESH} THEN list_append(s2, o.k2) ELSE s2 END
        FROM walk JOIN o ON o.rn = walk.rn + 1)
    SELECT seq, k1, k2 FROM walk WHERE ok""")
def _(t):
    """Valid scenes without duplicates under either key: the SQL walks them in order."""
    scenes = cut(keyed_scenes(t))
    return AC.first_wins(scenes, ["k1", "k2"], "seq").select("seq", "k1", "k2")


@query("w5_anchor_once_per_batch", """
    SELECT min(l_orderkey * 8 + l_linenumber) AS seq, l_suppkey, l_partkey FROM lines GROUP BY l_suppkey, l_partkey""")
def _(t):
    rows = t.lines.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"), "l_suppkey", "l_partkey")
    return AC.first_by_key(rows, ["l_suppkey", "l_partkey"], "seq")


@query("w6_quota_cutoff", """
    SELECT seq, category, kind FROM (SELECT seq, s.category, s.kind, quota, row_number() OVER (PARTITION BY s.category, s.kind ORDER BY seq) AS rn
      FROM (SELECT seq, category, CASE WHEN complexity = 'simple' THEN 'simple' ELSE 'complex' END AS kind FROM samples) s
      JOIN (SELECT category, complexity AS kind, quota // 10 AS quota FROM quotas) q ON q.category = s.category AND q.kind = s.kind) WHERE rn <= quota""")
def _(t):
    from plinth.catalog.q_aggregates import quota_table
    from plinth.plans.quotas import kind_of

    rows = cut(t.samples.select("seq", "category", kind_of(F.col("complexity")).alias("kind")))
    remaining = quota_table(t).select("category", F.col("complexity").alias("kind"), F.floor(F.col("quota") / 10).alias("remaining"))
    return AC.within_quota(rows, ["category", "kind"], "seq", remaining)


@query("w7_newest_logs", """
    SELECT user_id, event_id, rn FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 5""")
def _(t):
    return W.newest(t.events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 5).select("user_id", "event_id", "rn")


@query("w9_record_bounds", """
    SELECT conv_id, turn, (sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) - length(text))::BIGINT AS starts,
       (sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn))::BIGINT AS ends FROM conversations""")
def _(t):
    rows = t.conversations.select("conv_id", "turn", F.length("text").cast("long").alias("n"))
    return W.record_bounds(rows, "conv_id", "turn", "n").select("conv_id", "turn", "starts", "ends")


_FEED = "SELECT user_id, ts, event_id, (floor(value / 40))::BIGINT AS assets, event_type = 'error' AS missing FROM events"
SQL_VIEWS["feed"] = _FEED


def feed(t):
    return t.events.select("user_id", "ts", "event_id", F.floor(F.col("value") / 40).alias("assets"), (F.col("event_type") == "error").alias("missing"))


@query("w10_settled", """
    WITH a AS (SELECT *, CASE WHEN assets IS NOT DISTINCT FROM lag(assets) OVER w THEN 0 ELSE 1 END AS chg FROM feed WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
      b AS (SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM a)
    SELECT user_id, island::BIGINT AS island, any_value(assets) AS assets, floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000)::BIGINT AS seconds FROM b
    GROUP BY user_id, island HAVING any_value(assets) > 0 AND floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) > 3600""")
def _(t):
    found = W.settled(feed(t), ["user_id"], "ts", "event_id", "assets", F.lit(3600))
    return found.select("user_id", "island", "assets", "seconds")


@query("w11_grace_verdicts", """
    WITH a AS (SELECT *, max((NOT missing)::INTEGER) OVER w AS published, CASE WHEN missing IS NOT DISTINCT FROM lag(missing) OVER w THEN 0 ELSE 1 END AS chg
               FROM feed WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
      b AS (SELECT *, sum(chg) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM a),
      c AS (SELECT user_id, island::BIGINT AS island, max(published) AS published, floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000)::BIGINT AS seconds
            FROM b WHERE missing GROUP BY user_id, island)
    SELECT user_id, island, seconds, CASE WHEN published = 1 THEN 'vanished' ELSE 'never published' END AS verdict FROM c
    WHERE (published = 1 AND seconds > 7200) OR (published = 0 AND seconds > 3600)""")
def _(t):
    found = W.verdicts(feed(t), ["user_id"], "ts", "event_id", F.col("missing"), 3600, 7200)
    return found.select("user_id", "island", "seconds", "verdict")


@query("j18_positional_assignment", """
    SELECT p.request_id, p.i, p.relation, p.level, md5(p.request_id || p.i) AS reply FROM plan p WHERE p.i % 3 < 2""")
def _(t):
    dealt = cut(plan(t).select("request_id", "i", "relation", "level"))
    replies = dealt.where("i % 3 < 2").select("request_id", "i", F.md5(F.concat("request_id", F.col("i").cast("string"))).alias("reply"))
    extra = replies.select("request_id", (F.col("i") + 1000).alias("i"), "reply")
    return dealt.join(large(replies.unionByName(extra)), ["request_id", "i"])


@query("a21_first_request", """
    SELECT category, complexity, arg_min(request_id, order_key) AS request_id FROM plan_requests GROUP BY category, complexity""")
def _(t):
    requests = DL.requests(plan(t), SEED)
    return requests.groupBy("category", "complexity").agg(F.min_by("request_id", "order_key").alias("request_id"))


_ASSET_LINES = lambda role: f"string_agg('- ' || uid || ' — ' || substr(caption, 1, 220), chr(10) ORDER BY pos) FILTER (role = '{role}')"


@query("a22_scene_prompts", f"""
    WITH r AS (SELECT request_id, context, count(*) AS n, string_agg((i + 1) || '. ' || relation || ' — ' ||
           CASE level WHEN 'bare' THEN 'leave the place open' WHEN 'position' THEN 'say roughly where' ELSE 'name the part of the anchor that it touches' END,
           chr(10) ORDER BY i) AS lines FROM plan GROUP BY request_id, context),
      o AS (SELECT request_id, {_ASSET_LINES('anchor')} AS anchors, {_ASSET_LINES('placed')} AS placed FROM offer JOIN pool USING (uid) GROUP BY request_id)
    SELECT request_id, md5('Write ' || n || ' scene(s) for this setting: ' || context || chr(10) || chr(10) || 'Relations, scene by scene:' || chr(10) || lines
       || chr(10) || chr(10) || 'Anchors on offer (never twice):' || chr(10) || anchors
       || chr(10) || chr(10) || 'Objects to place on offer (may repeat):' || chr(10) || placed) AS prompt FROM r JOIN o USING (request_id)""")
def _(t):
    dealt = cut(plan(t))
    lines = offer(t, DL.requests(dealt, SEED)).join(t.pool.select("uid", "caption"), "uid").select(
        "request_id", "role", "pos", A.asset_line(F.col("uid"), F.col("caption")).alias("line"))
    return A.request_prompt(dealt, lines).withColumn("prompt", F.md5("prompt"))


def _tagger(prompts: list[str]) -> tuple[list[str | None], float]:
    """Deterministic stand-in for a tagging model: skips prompts of a certain length."""
    return [json.dumps({"n": len(p), "junk": len(p) % 3 == 0}) if len(p) % 7 else None for p in prompts], 0.004


@query("m1_model_map", """
    SELECT doc_id, CASE WHEN length(text) % 7 = 0 THEN 'pending' ELSE 'done' END AS state,
       CASE WHEN length(text) % 7 = 0 THEN -1 ELSE length(text) END AS n, length(text) % 7 > 0 AND length(text) % 3 = 0 AS junk FROM documents""")
def _(t):
    replies = MM.parsed(MM.model_map(t.documents, "doc_id", "text", _tagger, D.TAG_BATCH), "n long, junk boolean")
    return replies.select(
        "doc_id", F.when(F.col("data").isNull(), "pending").otherwise("done").alias("state"),
        F.coalesce("data.n", F.lit(-1)).alias("n"), F.coalesce("data.junk", F.lit(False)).alias("junk"),
    )
