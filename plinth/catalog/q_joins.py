"""Join queries (J), set operations (U) and sorts (L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plinth.catalog.registry import query
from plinth.catalog.sqlviews import IDS, SQL_VIEWS, r6, strings, uniform
from plinth.functions import text as T
from plinth.operators import filters as P
from plinth.operators import joins as J
from plinth.operators.ordering import hash_ranked
from plinth.plans import dimensions as D


@query("j1_assets_with_paths", "SELECT uid, aesthetic, glb FROM assets JOIN paths USING (uid)")
def _(t):
    return t.assets.select("uid", "aesthetic").join(t.paths, "uid")


@query("j2_annotations", """
    SELECT uid, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM assets LEFT JOIN annotations USING (uid)""")
def _(t):
    joined = t.assets.select("uid").join(t.annotations, "uid", "left")
    return joined.select("uid", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("quality", "toxic")])


@query("j3_pending_assets", "SELECT uid FROM assets WHERE uid NOT IN (SELECT uid FROM annotations)")
def _(t):
    return t.assets.select("uid").join(t.annotations.select("uid"), "uid", "left_anti")


SQL_VIEWS["offered"] = "SELECT DISTINCT l_orderkey AS request_id, l_partkey % 50 AS uid FROM lineitem WHERE l_returnflag <> 'R'"
SQL_VIEWS["returned"] = "SELECT l_orderkey AS request_id, l_linenumber, l_partkey % 50 AS uid FROM lines"


def offered_returned(t):
    uid = (F.col("l_partkey") % 50).alias("uid")
    offered = t.lineitem.where("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("request_id"), uid).distinct()
    return offered, t.lines.select(F.col("l_orderkey").alias("request_id"), "l_linenumber", uid)


@query("j4_offered_members", """
    SELECT request_id, l_linenumber, uid FROM returned r
    WHERE EXISTS (SELECT 1 FROM offered o WHERE o.request_id = r.request_id AND o.uid = r.uid)""")
def _(t):
    offered, returned = offered_returned(t)
    return returned.join(offered, ["request_id", "uid"], "left_semi").select("request_id", "l_linenumber", "uid")


@query("j4_not_offered", """
    SELECT request_id, l_linenumber, uid FROM returned r
    WHERE NOT EXISTS (SELECT 1 FROM offered o WHERE o.request_id = r.request_id AND o.uid = r.uid)""")
def _(t):
    offered, returned = offered_returned(t)
    return returned.join(offered, ["request_id", "uid"], "left_anti").select("request_id", "l_linenumber", "uid")


@query("j5_positional_replies", """
    SELECT q.conv_id, q.turn, coalesce(md5(a.text), 'pending') AS reply
    FROM conversations q LEFT JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant'
    WHERE q.role = 'user'""")
def _(t):
    asked = t.conversations.where("role = 'user'").select("conv_id", "turn")
    answers = t.conversations.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.md5("text").alias("reply"))
    return asked.join(answers, ["conv_id", "turn"], "left").withColumn("reply", F.coalesce("reply", F.lit("pending")))


@query("j6_seed_lookup", """
    SELECT seq, a.p_brand AS anchor_brand, a.p_size AS anchor_size, b.p_brand AS placed_brand, b.p_size AS placed_size
    FROM samples JOIN part a ON a.p_partkey = anchor_partkey JOIN part b ON b.p_partkey = placed_partkey""")
def _(t):
    def seed(role):
        return t.part.select(F.col("p_partkey").alias(f"{role}_partkey"), F.col("p_brand").alias(f"{role}_brand"), F.col("p_size").alias(f"{role}_size"))

    joined = t.samples.select("seq", "anchor_partkey", "placed_partkey").join(seed("anchor"), "anchor_partkey").join(seed("placed"), "placed_partkey")
    return joined.select("seq", "anchor_brand", "anchor_size", "placed_brand", "placed_size")


@query("j7_role_rows", """
    SELECT seq, 'anchor' AS role, anchor_partkey AS partkey, anchor_name AS name, coalesce(anchor_mesh, '-') AS mesh FROM samples
    UNION ALL SELECT seq, 'placed', placed_partkey, placed_name, coalesce(placed_mesh, '-') FROM samples""")
def _(t):
    rows = J.role_rows(t.samples, ["partkey", "name", "mesh"], ["seq"])
    return rows.withColumn("mesh", F.coalesce("mesh", F.lit("-")))


@query("j7_recorded_meshes", """
    SELECT seq, CASE WHEN anchor_partkey % 4 = 0 THEN 'new_anchor.glb' ELSE coalesce(anchor_mesh, '-') END AS anchor_mesh,
           CASE WHEN placed_partkey % 4 = 0 THEN 'new_placed.glb' ELSE coalesce(placed_mesh, '-') END AS placed_mesh FROM samples""")
def _(t):
    collected = J.role_rows(t.samples, ["partkey"], ["seq"]).where("partkey % 4 = 0").select(
        "seq", "role", F.concat(F.lit("new_"), "role", F.lit(".glb")).alias("mesh")
    )
    wide = J.role_columns(collected, "seq", ["mesh"])
    fields = ["anchor_mesh", "placed_mesh"]
    return J.updated(t.samples.select("seq", *fields), wide, "seq", fields).select(
        "seq", *[F.coalesce(f, F.lit("-")).alias(f) for f in fields]
    )


@query("j8_skip_done", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def _(t):
    done = t.orders.where("o_orderstatus = 'F'").select("o_orderkey")
    return t.orders.select("o_orderkey").join(done, "o_orderkey", "left_anti")


SQL_VIEWS["wanted"] = "SELECT page_id, 'o' || page_id AS key FROM pages"


def deliveries(t):
    """Delivered files for two pages of three, named ``run__<host>__<key>.glb``."""
    key = F.concat(F.lit("o"), "page_id")
    host = F.regexp_extract("url", "//([^/]*)", 1)
    file = F.concat(F.lit("out/glb/run__"), host, F.lit("__"), key, F.lit(".glb"))
    sent = t.pages.where("page_id % 3 > 0").select(file.alias("file"))
    return sent.select(T.key_of_file(F.col("file")).alias("key"), "file"), t.pages.select("page_id", key.alias("key"))


@query("j9_deliveries_by_key", """
    SELECT page_id, key, 'out/glb/run__' || regexp_extract(url, '//([^/]*)', 1) || '__' || key || '.glb' AS file
    FROM wanted JOIN pages USING (page_id) WHERE page_id % 3 > 0""")
def _(t):
    found, wanted = deliveries(t)
    return wanted.join(found, "key").select("page_id", "key", "file")


@query("j9_missing_keys", "SELECT page_id, key FROM wanted WHERE page_id % 3 = 0")
def _(t):
    found, wanted = deliveries(t)
    return wanted.join(found.select("key"), "key", "left_anti").select("page_id", "key")


SQL_VIEWS["imaged"] = """
    SELECT d.doc_id, coalesce('q' || l.quality, p.url, '-') AS image,
       CASE WHEN l.quality IS NOT NULL THEN 'normalized' WHEN p.url IS NOT NULL THEN 'reference' ELSE 'none' END AS provenance
    FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN pages p ON p.page_id = d.doc_id"""


def imaged(t):
    first = t.labels.select("doc_id", F.concat(F.lit("q"), "quality").alias("image"))
    second = t.pages.select(F.col("page_id").alias("doc_id"), F.col("url").alias("image"))
    found = J.with_fallback(t.documents.select("doc_id"), first, second, "doc_id", "image")
    return found.withColumn("image", F.coalesce("image", F.lit("-")))


@query("j10_image_fallback", "SELECT doc_id, image, provenance FROM imaged")
def _(t):
    return imaged(t).select("doc_id", "image", "provenance")


@query("j11_reattach", """
    SELECT event_id, json_extract(props, '$.k')::BIGINT AS p_partkey, p_name FROM events
    JOIN part ON p_partkey = json_extract(props, '$.k')::BIGINT""")
def _(t):
    saved = t.events.select(
        "event_id", F.explode(F.from_json("props", "map<string,bigint>")).alias("key", "p_partkey")
    )
    return saved.join(t.part.select("p_partkey", "p_name"), "p_partkey").select("event_id", "p_partkey", "p_name")


_CUT = "2024-01-15 12:00:00"


@query("j12_latest_log_before_cutoff", f"""
    SELECT user_id, coalesce(max(event_id) FILTER (ts < TIMESTAMP '{_CUT}' AND rn = 1), -1) AS event_id FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, ts < TIMESTAMP '{_CUT}' ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    GROUP BY user_id""")
def _(t):
    users = t.events.select("user_id").distinct()
    logs = t.events.select("user_id", "ts", "event_id")
    found = J.latest_before(users, logs, "user_id", "ts", F.lit(_CUT).cast("timestamp_ntz"))
    return found.select("user_id", F.coalesce("event_id", F.lit(-1)).alias("event_id"))


@query("j12_as_of", """
    SELECT c.event_id, coalesce(p.value, -1) AS value FROM (SELECT * FROM events WHERE event_type = 'click') c
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p ON c.user_id = p.user_id AND c.ts > p.ts""")
def _(t):
    rows = t.events.select("user_id", "ts", "event_id", "value", "event_type")
    clicks = rows.where("event_type = 'click'").select("user_id", "ts", "event_id")
    bought = rows.where("event_type = 'purchase'").select("user_id", "ts", "event_id", "value")
    found = J.as_of(clicks, bought, "user_id", "ts", "value", "event_id")
    return found.select("event_id", F.coalesce("value", F.lit(-1.0)).alias("value"))


@query("j13_matching_pose", """
    SELECT sample_id, sample_id % 3 = 0 AS current FROM poses""")
def _(t):
    pos = F.array("cx", "cy", "cz")
    baked = t.poses.select("sample_id", pos.alias("position"), F.array("yaw", "pitch", "roll").alias("rotation"))
    wobble = F.when(F.col("sample_id") % 3 == 0, 5e-5).otherwise(5e-4)
    logs = t.poses.select(
        "sample_id", F.transform(pos, lambda v: v + wobble).alias("position"), F.array("yaw", "pitch", "roll").alias("rotation")
    )
    return J.matching_pose(logs, baked, "sample_id", ["position", "rotation"]).select("sample_id", "current")


@query("j16_work_once_per_uid", """
    SELECT l_orderkey, l_linenumber, md5(l_partkey::VARCHAR || p_name) AS fetched FROM lines JOIN part ON p_partkey = l_partkey""")
def _(t):
    def fetch(uids):
        named = uids.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
        return named.select("l_partkey", F.md5(F.concat(F.col("l_partkey").cast("string"), "p_name")).alias("fetched"))

    rows = t.lines.select("l_orderkey", "l_linenumber", "l_partkey")
    return J.once_per_key(rows, "l_partkey", fetch).select("l_orderkey", "l_linenumber", "fetched")


def _losses(t, permanent_flag):
    missing = t.lines.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber")
    permanent = t.lines.where(F.col("l_returnflag") == permanent_flag).agg(F.count(F.lit(1)).alias("n")).scalar()
    return t.lines.select("l_orderkey", "l_linenumber"), J.abandoned(missing, permanent)


@query("j17_abandon_complete_losses", """
    SELECT l_orderkey, l_linenumber FROM lines WHERE l_orderkey NOT IN (
      SELECT l_orderkey FROM lines WHERE l_returnflag = 'R'
        AND (SELECT count(*) FROM lines WHERE l_returnflag = 'R') = (SELECT count(*) FROM lines WHERE l_returnflag = 'R'))""")
def _(t):
    rows, doomed = _losses(t, "R")
    return rows.join(doomed.select("l_orderkey").distinct(), "l_orderkey", "left_anti")


@query("j17_keep_when_retryable", "SELECT l_orderkey, l_linenumber FROM lines")
def _(t):
    rows, doomed = _losses(t, "A")
    return rows.join(doomed.select("l_orderkey").distinct(), "l_orderkey", "left_anti")


@query("j19_quota_grid", f"""
    SELECT category, complexity, count(seq) AS samples FROM (SELECT unnest({IDS}) AS category) CROSS JOIN (SELECT unnest(['simple', 'complex']) AS complexity)
    LEFT JOIN (SELECT seq, category, CASE WHEN complexity = 'simple' THEN 'simple' ELSE 'complex' END AS complexity FROM samples) s
      USING (category, complexity) GROUP BY ALL""")
def _(t):
    from plinth.plans.dimensions import kinds
    from plinth.plans.quotas import created_counts

    grid = kinds(t.spark).select("category", "complexity")
    joined = grid.join(created_counts(t.samples), ["category", "complexity"], "left")
    return joined.select("category", "complexity", F.coalesce("created", F.lit(0)).alias("samples"))


@query("j20_role_pairs", """
    SELECT a.seq, a.anchor_partkey = a.placed_partkey AS same, pa.p_size::BIGINT - pb.p_size AS difference FROM samples a
    JOIN part pa ON pa.p_partkey = anchor_partkey JOIN part pb ON pb.p_partkey = placed_partkey""")
def _(t):
    sizes = t.part.select(F.col("p_partkey").alias("partkey"), "p_size")
    rows = J.role_rows(t.samples, ["partkey"], ["seq"]).join(sizes, "partkey")
    wide = J.role_columns(rows, "seq", ["partkey", "p_size"])
    return wide.select(
        "seq", (F.col("anchor_partkey") == F.col("placed_partkey")).alias("same"),
        (F.col("anchor_p_size") - F.col("placed_p_size")).cast("long").alias("difference"),
    )


# ---- sorts and limits -------------------------------------------------------------------

@query("l1_sorted_names", "SELECT p_name, p_partkey FROM part ORDER BY p_name, p_partkey")
def _(t):
    return t.part.select("p_name", "p_partkey").orderBy("p_name", "p_partkey")


@query("l3_row_cap", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 50")
def _(t):
    return t.documents.select("doc_id", "n_chars").orderBy(F.col("n_chars").desc(), "doc_id").limit(50)


@query("l4_seeded_shuffle", """
    SELECT doc_id, row_number() OVER (ORDER BY md5('deck:' || doc_id::VARCHAR), doc_id) AS place FROM documents""")
def _(t):
    keyed = t.documents.select("doc_id", T.md5_order("deck", F.col("doc_id")).alias("k"))
    return hash_ranked(keyed, "k", "doc_id", out="place").select("doc_id", "place")


# ---- set operations ---------------------------------------------------------------------

@query("u1_existing_and_new", """
    SELECT o_orderkey, 'old' AS origin, o_totalprice, '-' AS priority FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, 'new', o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'""")
def _(t):
    old = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("old").alias("origin"), "o_totalprice")
    new = t.orders.where("o_orderstatus <> 'F'").select("o_orderkey", F.lit("new").alias("origin"), "o_totalprice", F.col("o_orderpriority").alias("priority"))
    return old.unionByName(new, allowMissingColumns=True).withColumn("priority", F.coalesce("priority", F.lit("-")))


@query("u2_distinct_anchors", "SELECT DISTINCT l_partkey FROM lineitem")
def _(t):
    return t.lineitem.select("l_partkey").distinct()


@query("u3_pending_keys", "SELECT o_orderkey FROM orders EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    return t.orders.select("o_orderkey").exceptAll(t.orders.where("o_orderstatus = 'F'").select("o_orderkey"))


@query("u4_duplicate_keys", """
    SELECT anchor_name || '|' || placed_name AS key FROM samples WHERE category = 'rigid'
    INTERSECT SELECT anchor_name || '|' || placed_name FROM samples WHERE category = 'soft'""")
def _(t):
    key = F.concat_ws("|", "anchor_name", "placed_name").alias("key")
    return t.samples.where("category = 'rigid'").select(key).intersect(t.samples.where("category = 'soft'").select(key))
