"""Aggregation queries (A) over assets, samples, feeds and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from plinth.catalog.q_joins import imaged
from plinth.catalog.registry import query
from plinth.catalog.sqlviews import IDS, SQL_VIEWS, r6
from plinth.functions import text as T
from plinth.operators import aggregates as A
from plinth.operators import filters as P
from plinth.operators import joins as J
from plinth.operators import windows as W
from plinth.plans import dimensions as D
from plinth.plans import quotas as Q


@query("a1_license_histogram", "SELECT coalesce(license, 'unknown') AS license, count(*) AS assets FROM pool GROUP BY 1")
def _(t):
    return A.license_histogram(t.pool)


@query("a2_pool_summary", f"""
    SELECT (SELECT count(*) FROM pool) AS total, (SELECT count(*) FROM pool WHERE junk) AS junk, category,
       (SELECT count(*) FROM pool WHERE list_contains(anchor, category)) AS anchors,
       (SELECT count(*) FROM pool WHERE list_contains(placed, category)) AS placed FROM (SELECT unnest({IDS}) AS category)""")
def _(t):
    return A.pool_summary(t.spark, t.pool)


_KIND = "CASE WHEN complexity = 'simple' THEN 'simple' ELSE 'complex' END"


@query("a3_category_matrix", f"""
    SELECT coalesce(category, 'all') AS category, count(*) FILTER (kind = 'simple') AS simple,
           count(*) FILTER (kind = 'complex') AS complex, count(*) AS total
    FROM (SELECT category, {_KIND} AS kind FROM samples) GROUP BY ROLLUP (category)""")
def _(t):
    return A.category_matrix(t.samples)


_WEIGHTS = "(VALUES " + ", ".join(f"({i}, '{c[0]}', {c[1]}::DOUBLE)" for i, c in enumerate(D.CATEGORIES)) + ") c(ord, category, weight)"
_SHARES = (
    f"SELECT *, total * weight / (SELECT sum(weight) FROM {_WEIGHTS}) AS exact FROM {_WEIGHTS}, "
    "(SELECT count(*)::DOUBLE AS total FROM orders)"
)
SQL_VIEWS["quotas"] = f"""
    SELECT category, complexity, (CASE complexity WHEN 'simple' THEN ceil(q / 2) ELSE floor(q / 2) END)::BIGINT AS quota FROM (
      SELECT category, floor(exact) + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, ord)
                <= total - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS q FROM ({_SHARES})),
      (VALUES ('simple'), ('complex')) k(complexity)"""


def quota_table(t):
    return Q.quotas(t.spark, t.orders.agg(F.count(F.lit(1)).alias("n")).scalar())


@query("a5_quotas", "SELECT category, complexity, quota FROM quotas")
def _(t):
    return quota_table(t).select("category", "complexity", "quota")


SQL_VIEWS["shortfalls"] = f"""
    SELECT category, complexity, quota, coalesce(n, 0) AS created, greatest(0, quota - coalesce(n, 0)) AS short FROM quotas
    LEFT JOIN (SELECT category, {_KIND} AS complexity, count(*) AS n FROM samples GROUP BY 1, 2) USING (category, complexity)"""


def shortfalls(t):
    return Q.shortfall(quota_table(t), t.samples)


@query("a4_shortfall", "SELECT category, complexity, quota, created, short FROM shortfalls")
def _(t):
    return shortfalls(t).select("category", "complexity", "quota", "created", "short")


@query("a6_stage_counts", """
    SELECT context, count(*) AS samples, count(*) FILTER (anchor_image IS NOT NULL AND placed_image IS NOT NULL) AS imaged,
      count(*) FILTER (anchor_mesh IS NOT NULL AND placed_mesh IS NOT NULL) AS meshed,
      count(combined_size) AS placed FROM samples GROUP BY context""")
def _(t):
    return t.samples.groupBy("context").agg(
        F.count(F.lit(1)).alias("samples"), F.count_if(P.has_images()).alias("imaged"),
        F.count_if(P.is_meshed()).alias("meshed"), F.count_if(P.is_placed()).alias("placed"),
    )


@query("a7_recent_placed_names", """
    SELECT category, context, string_agg(placed_name, ', ' ORDER BY seq) AS avoid FROM (
      SELECT *, row_number() OVER (PARTITION BY category, context ORDER BY seq DESC) AS rn FROM samples) WHERE rn <= 40
    GROUP BY category, context""")
def _(t):
    return W.recent_list(t.samples, ["category", "context"], "seq", "placed_name", D.AVOID_PLACED, "avoid")


@query("a7_recent_anchors", """
    SELECT anchor_name, first_seq FROM (SELECT anchor_name, min(seq) AS first_seq FROM samples GROUP BY anchor_name)
    ORDER BY first_seq DESC LIMIT 60""")
def _(t):
    first = t.samples.groupBy("anchor_name").agg(F.min("seq").alias("first_seq"))
    return first.orderBy(F.col("first_seq").desc()).limit(D.AVOID_ANCHORS)


@query("a8_spend", f"""
    SELECT event_type, count(*) FILTER (value > 1) AS calls, {r6('sum(value) FILTER (value > 1)')} AS cost,
           {r6('sum(value) FILTER (value > 1) / nullif(count(*) FILTER (value > 1), 0)')} AS per_call FROM events GROUP BY event_type""")
def _(t):
    called = F.col("value") > 1
    grouped = t.events.groupBy("event_type").agg(F.count_if(called).alias("calls"), F.sum(F.when(called, F.col("value"))).alias("cost"))
    return grouped.select("event_type", "calls", T.fixed(F.col("cost")).alias("cost"),
                          T.fixed(F.col("cost") / F.nullif("calls", F.lit(0))).alias("per_call"))


@query("a11_box_ratios", f"""
    SELECT p_partkey, sx, sy, sz, {r6('sx / greatest(sx, sy, sz, 1e-9)')} AS sx_ratio, {r6('sy / greatest(sx, sy, sz, 1e-9)')} AS sy_ratio,
           {r6('sz / greatest(sx, sy, sz, 1e-9)')} AS sz_ratio, {r6('sx / sy')} AS x_to_y
    FROM (SELECT p_partkey, p_size::DOUBLE AS sx, (1 + p_partkey % 7)::DOUBLE AS sy, (1 + p_partkey % 5)::DOUBLE AS sz FROM part)""")
def _(t):
    sizes = t.part.select(
        "p_partkey", F.col("p_size").cast("double").alias("sx"), (1 + F.col("p_partkey") % 7).cast("double").alias("sy"),
        (1 + F.col("p_partkey") % 5).cast("double").alias("sz"),
    ).withColumn("x_to_y", A.dimension_ratio(F.col("sx"), F.col("sy")))
    return A.axis_ratios(sizes, ["sx", "sy", "sz"])


@query("a16_lane_counts", """
    SELECT context, lane, count(*) AS jobs FROM (SELECT context, 'geo' AS lane FROM samples WHERE anchor_image IS NOT NULL
      UNION ALL SELECT context, 'tex' FROM samples WHERE placed_image IS NOT NULL) GROUP BY ALL""")
def _(t):
    rows = J.role_rows(t.samples, ["image"], ["context"]).where("image is not null")
    return rows.groupBy("context", P.lane(F.col("role")).alias("lane")).agg(F.count(F.lit(1)).alias("jobs"))


@query("a17_image_provenance", "SELECT provenance, count(*) AS images FROM imaged GROUP BY provenance")
def _(t):
    return imaged(t).groupBy("provenance").agg(F.count(F.lit(1)).alias("images"))


_FLAGS = "list_filter([CASE WHEN pitch > 45 THEN 'drifted' END, CASE WHEN cx > 0.9 THEN 'dropped_far' END, CASE WHEN cy > 0.06 THEN 'no_contact' END], lambda f: f IS NOT NULL)"


@query("a18_flag_frequencies", f"""
    SELECT contact, flag, count(*) AS samples FROM (
      SELECT ['rest', 'lean', 'attach', 'embed', 'drape', 'none'][sample_id % 6 + 1] AS contact,
             unnest(CASE WHEN len({_FLAGS}) = 0 THEN ['-'] ELSE {_FLAGS} END) AS flag FROM poses) GROUP BY ALL""")
def _(t):
    contacts = F.array(*[F.lit(c) for c in D.CONTACTS])
    flags = F.array_compact(F.array(
        F.when(F.col("pitch") > 45, "drifted"), F.when(F.col("cx") > 0.9, "dropped_far"), F.when(F.col("cy") > 0.06, "no_contact")))
    rows = t.poses.select(F.get(contacts, (F.col("sample_id") % 6).cast("int")).alias("contact"), F.explode_outer(flags).alias("flag"))
    return rows.groupBy("contact", F.coalesce("flag", F.lit("-")).alias("flag")).agg(F.count(F.lit(1)).alias("samples"))


SQL_VIEWS["audit"] = """
    SELECT seq, category, round(pb.p_size * (pb.p_retailprice / 1000) / pa.p_size, 3) AS ratio FROM samples
    JOIN part pa ON pa.p_partkey = anchor_partkey JOIN part pb ON pb.p_partkey = placed_partkey"""


def audit(t):
    size = lambda role: t.part.select(F.col("p_partkey").alias(f"{role}_partkey"), F.col("p_size").alias(f"{role}_raw"),
                                      (F.col("p_retailprice") / 1000).alias(f"{role}_scale"))
    pairs = t.samples.select("seq", "category", "anchor_partkey", "placed_partkey").join(size("anchor"), "anchor_partkey").join(size("placed"), "placed_partkey")
    return A.scale_audit(pairs.select("seq", "category", F.col("anchor_raw").alias("a_raw"), F.col("placed_raw").alias("b_raw"), F.col("placed_scale").alias("scale")))


@query("a19_scale_audit", """
    SELECT category, count(*) AS samples, round(quantile_cont(ratio, 0.5), 6) AS median, min(ratio) AS least, max(ratio) AS most,
           count(*) FILTER (ratio > 10) AS outliers FROM audit GROUP BY category""")
def _(t):
    return A.audit_summary(audit(t), 10.0).withColumn("median", F.round("median", 6))


@query("l5_worst_ratios", "SELECT seq, ratio FROM audit ORDER BY ratio DESC, seq LIMIT 25")
def _(t):
    rows = audit(t).select("seq", F.round("ratio", 3).alias("ratio"))
    return rows.orderBy(F.col("ratio").desc(), "seq").limit(25)


SQL_VIEWS["tag_batches"] = """
    SELECT doc_id, text, (rn - 1) // 40 AS batch, (rn - 1) % 40 + 1 AS i FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS rn FROM documents)"""


@query("a22_tag_prompts", """
    SELECT batch, md5(string_agg(i || '. ' || substr(text, 1, 240), chr(10) ORDER BY i)) AS prompt FROM tag_batches GROUP BY batch""")
def _(t):
    rows = W.batches(t.documents.select("doc_id", "text"), "doc_id", D.TAG_BATCH)
    return A.numbered_captions(rows, "batch", "i", "text").withColumn("prompt", F.md5("prompt"))


@query("a24_next_id", """
    SELECT 'Customer#' || CASE WHEN length(n::VARCHAR) >= 4 THEN n::VARCHAR ELSE lpad(n::VARCHAR, 4, '0') END AS next_id
    FROM (SELECT coalesce(max(regexp_extract(c_name, '^Customer#([0-9]+)$', 1)::BIGINT), 0) + 1 AS n FROM customer)""")
def _(t):
    return A.next_id(t.customer, "c_name", "Customer#")


@query("a25_delivered_files", """
    SELECT user_id, count(*) FILTER (event_type IN ('view', 'click')) AS files FROM events GROUP BY user_id""")
def _(t):
    name = F.concat(F.lit("o"), "event_id", F.when(F.col("event_type") == "view", ".glb").when(F.col("event_type") == "click", ".GLB").otherwise(".png"))
    return t.events.groupBy("user_id").agg(F.count_if(name.rlike(r"(?i)\.glb$")).alias("files"))
