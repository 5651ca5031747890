"""Queries over asset and sample rows: projections, predicates, validators (P), scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from plinth.catalog.registry import query
from plinth.catalog.sqlviews import IDS, SQL_VIEWS, r6, slug, strings, strip, uniform
from plinth.functions import text as T
from plinth.operators import acceptance as A
from plinth.operators import filters as P
from plinth.plans import dealing as DL
from plinth.plans import dimensions as D
from plinth.sources import files as S
from plinth.sources import logs as L

LICENSES = ["src1", "src2", "src3", "unknown"]


@query("p1_uid_from_url", """
    SELECT page_id, CASE WHEN page_id % 5 > 0 THEN md5(page_id::VARCHAR) END AS uid FROM pages""")
def _(t):
    tail = F.concat(F.lit("/"), F.md5(F.col("page_id").cast("string")), F.when(F.col("page_id") % 2 == 0, "/").otherwise(""))
    link = F.concat("url", F.when(F.col("page_id") % 5 > 0, tail).otherwise(""))
    return t.pages.select("page_id", T.uid_from_url(link).alias("uid"))


@query("p2_first_last_caption", f"""
    SELECT doc_id, md5({strip("split_part(text, chr(10), 1)")}) AS caption,
           md5({strip("split_part(text, chr(10), -1)")}) AS short
    FROM documents WHERE doc_id % 4 > 0""")
def _(t):
    good = F.to_json(F.split("text", "\n"))
    broken = F.when(F.col("doc_id") % 8 == 0, "[]").otherwise("not json")
    rows = t.documents.select(
        F.concat(F.lit("https://host/"), F.md5(F.col("doc_id").cast("string"))).alias("identifier"),
        F.col("n_chars").cast("string").alias("aesthetic"),
        F.when(F.col("doc_id") % 4 > 0, good).otherwise(broken).alias("captions"),
    )
    ids = t.documents.select(F.md5(F.col("doc_id").cast("string")).alias("uid"), "doc_id")
    found = S.caption_assets(rows, ids)
    return found.select("doc_id", F.md5("caption").alias("caption"), F.md5("short").alias("short"))


@query("p3_slug", f"""
    SELECT p_partkey, {slug("p_name || ' / ' || p_brand || '!'")} AS slug,
           {slug("'(' || p_size || ')' || CASE WHEN p_size > 25 THEN '' ELSE p_type END")} AS slug2 FROM part""")
def _(t):
    odd = F.concat(F.lit("("), F.col("p_size"), F.lit(")"), F.when(F.col("p_size") > 25, "").otherwise(F.col("p_type")))
    name = F.concat("p_name", F.lit(" / "), "p_brand", F.lit("!"))
    return t.part.select("p_partkey", T.slug(name).alias("slug"), T.slug(odd).alias("slug2"))


_PLACED_SLUG = f"CASE WHEN {slug('anchor_name')} = {slug('placed_name')} THEN {slug('placed_name')} || '_b' ELSE {slug('placed_name')} END"


@query("p4_role_stems", f"""
    SELECT seq, {slug('anchor_name')} || '_' || uuid AS anchor_stem, {_PLACED_SLUG} || '_' || uuid AS placed_stem,
           {slug('anchor_name')} || '_' || uuid || '.png' AS anchor_image FROM samples""")
def _(t):
    a, b = F.col("anchor_name"), F.col("placed_name")
    anchor = T.stem(T.slug(a), F.col("uuid"))
    return t.samples.select(
        "seq", anchor.alias("anchor_stem"), T.stem(T.placed_slug(a, b), F.col("uuid")).alias("placed_stem"),
        T.image_name(anchor).alias("anchor_image"),
    )


@query("p5_stage_predicates", """
    SELECT seq, combined_size IS NOT NULL AS placed, anchor_mesh IS NOT NULL AND placed_mesh IS NOT NULL AS meshed,
           anchor_image IS NOT NULL AND placed_image IS NOT NULL AS imaged,
           (anchor_mesh IS NULL)::INTEGER + (placed_mesh IS NULL)::INTEGER AS to_fetch FROM samples""")
def _(t):
    missing = F.col("anchor_mesh").isNull().cast("int") + F.col("placed_mesh").isNull().cast("int")
    return t.samples.select("seq", P.is_placed().alias("placed"), P.is_meshed().alias("meshed"),
                            P.has_images().alias("imaged"), missing.alias("to_fetch"))


@query("p6_usable_pool", f"""
    SELECT uid, coalesce(license, 'unknown') AS license FROM pool
    WHERE NOT junk AND coalesce(license, 'unknown') IN ({", ".join(f"'{v}'" for v in LICENSES)})""")
def _(t):
    return DL.usable_pool(t.pool, LICENSES).select("uid", F.coalesce("license", F.lit("unknown")).alias("license"))


MEMBERS_SQL = """
    SELECT DISTINCT uid, 'anchor' AS role, unnest(list_append(anchor, 'noncontact')) AS category FROM pool WHERE NOT junk
    UNION ALL SELECT uid, 'placed', unnest(placed) FROM pool WHERE NOT junk"""
SQL_VIEWS["members"] = MEMBERS_SQL


@query("p7_category_members", "SELECT uid, role, category FROM members")
def _(t):
    return DL.role_members(t.pool).select("uid", "role", "category")


def proposals(t):
    """Generated scenes with faults of every kind, from samples."""
    s = F.col("seq")
    words = F.concat_ws(" ", "placed_name", "relation")
    long_tail = F.repeat(F.lit(" next to it"), 6)
    text = (
        F.when(s % 7 == 1, F.concat_ws(" ", words, "anchor_name"))
        .when(s % 7 == 2, F.concat_ws(" ", "relation", F.lit("the"), "anchor_name"))
        .when(s % 7 == 3, F.concat_ws(" ", "placed_name", F.lit("stabbed into the"), "anchor_name"))
        .when(s % 7 == 4, F.concat(F.col("placement"), long_tail))
        .otherwise(F.col("placement"))
    )
    plain = lambda n: F.element_at(F.split(n, " "), -1)
    return t.samples.select(
        "seq", "category", "relation",
        F.md5(F.col("anchor_partkey").cast("string")).alias("anchor_uid"),
        F.md5(F.col("placed_partkey").cast("string")).alias("placed_uid"),
        F.when(s % 11 == 0, "one two three four").when(s % 3 == 0, plain("anchor_name")).otherwise(F.col("anchor_name")).alias("anchor_name"),
        F.when(s % 13 == 0, "  ").when(s % 3 == 0, plain("placed_name")).otherwise(F.col("placed_name")).alias("placed_name"),
        F.col("anchor_image").alias("anchor_description"), F.coalesce("placed_image", F.lit("x")).alias("placed_description"),
        text.alias("placement"),
        (F.col("anchor_partkey") % 9 > 0).alias("anchor_offered"), (F.col("placed_partkey") % 17 > 0).alias("placed_offered"),
        (s % 19 == 0).alias("anchor_reused"),
    )


SQL_VIEWS["proposals"] = """
    SELECT seq, category, relation, md5(anchor_partkey::VARCHAR) AS anchor_uid, md5(placed_partkey::VARCHAR) AS placed_uid,
      CASE WHEN seq % 11 = 0 THEN 'one two three four' WHEN seq % 3 = 0 THEN split_part(anchor_name, ' ', -1) ELSE anchor_name END AS anchor_name,
      CASE WHEN seq % 13 = 0 THEN '  ' WHEN seq % 3 = 0 THEN split_part(placed_name, ' ', -1) ELSE placed_name END AS placed_name,
      anchor_image AS anchor_description, coalesce(placed_image, 'x') AS placed_description,
      CASE WHEN seq % 7 = 1 THEN placed_name || ' ' || relation || ' ' || anchor_name
           WHEN seq % 7 = 2 THEN relation || ' the ' || anchor_name
           WHEN seq % 7 = 3 THEN placed_name || ' stabbed into the ' || anchor_name
           WHEN seq % 7 = 4 THEN placement || repeat(' next to it', 6) ELSE placement END AS placement,
      anchor_partkey % 9 > 0 AS anchor_offered, placed_partkey % 17 > 0 AS placed_offered, seq % 19 = 0 AS anchor_reused
    FROM samples"""

_WORDS = lambda x: rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> '')"
_STYLED = lambda x: f"len({_WORDS(f'lower({x})')}) > 1 AND list_has_any({_WORDS(f'lower({x})')}, {strings(D.STYLE_WORDS)})"
SQL_VIEWS["judged"] = rf"""
    SELECT *, CASE WHEN NOT anchor_offered THEN 'anchor not offered'
      WHEN anchor_reused THEN 'anchor reused'
      WHEN NOT placed_offered THEN 'placed not offered'
      WHEN len({_WORDS('anchor_name')}) NOT BETWEEN 1 AND 3 THEN 'bad anchor name'
      WHEN {_STYLED('anchor_name')} THEN 'styled anchor name'
      WHEN len({_WORDS('placed_name')}) NOT BETWEEN 1 AND 3 THEN 'bad placed name'
      WHEN {_STYLED('placed_name')} THEN 'styled placed name'
      WHEN coalesce(trim(anchor_description), '') = '' OR coalesce(trim(placed_description), '') = '' THEN 'empty description'
      WHEN len({_WORDS('placement')}) > {D.PHRASE_MAX_WORDS} THEN 'phrase too long'
      WHEN NOT contains(lower(placement), 'the ' || lower(anchor_name)) THEN 'anchor without article'
      WHEN NOT contains(lower(placement), lower(placed_name)) THEN 'placed object missing'
      WHEN regexp_matches(replace(replace(lower(placement), lower(anchor_name), ' '), lower(placed_name), ' '),
                          '\b({"|".join(D.FORCEFUL_STEMS)})') THEN 'forceful verb' END AS problem
    FROM proposals"""


def judged(t):
    problem = A.scene_problem(F.col("anchor_offered"), F.col("anchor_reused"), F.col("placed_offered"))
    return proposals(t).withColumn("problem", problem)


@query("p8_scene_validator", "SELECT seq, coalesce(problem, 'ok') AS problem FROM judged")
def _(t):
    return judged(t).select("seq", F.coalesce("problem", F.lit("ok")).alias("problem"))


@query("p9_answer_validator", """
    SELECT sample_id, sample_id % 7 > 0 AND sample_id % 11 > 0 AND sample_id % 13 > 0 AND sample_id % 17 > 0
       AND sample_id % 19 > 0 AND sample_id % 23 > 0 AS ok FROM poses""")
def _(t):
    s = F.col("sample_id")
    zero = F.when(s % 7 == 0, 0.0).otherwise(F.col("scale"))
    yaw = F.when(s % 11 == 0, F.lit(float("nan"))).otherwise(F.col("yaw"))
    center = F.when(s % 13 == 0, F.array("cx", "cy")).otherwise(F.array("cx", "cy", "cz"))
    contact = F.when(s % 17 == 0, "glue").otherwise("rest")
    direction = F.when(s % 19 == 0, F.array("cx", "cy", F.lit(float("inf")))).otherwise(F.array("cx", "cy", "cz"))
    fraction = F.when(s % 23 == 0, F.lit(None).cast("double")).otherwise(F.col("cz"))
    ok = P.answer_ok(zero, [yaw, F.col("pitch"), F.col("roll")], center, contact, direction, fraction)
    return t.poses.select("sample_id", ok.alias("ok"))


@query("p10_required_fields", """
    SELECT doc_id FROM documents WHERE split_part(text, chr(10), 1) <> '' AND split_part(text, chr(10), 2) <> ''
       AND split_part(text, chr(10), 3) <> ''""")
def _(t):
    line = lambda n: F.get(F.split("text", "\n"), n)
    return t.documents.where(P.filled(line(0), line(1), line(2))).select("doc_id")


@query("p11_tag_cleaner", """
    SELECT uid, junk, CASE WHEN junk THEN '' ELSE array_to_string(anchor, ',') END AS anchor,
           CASE WHEN junk THEN '' ELSE array_to_string(placed, ',') END AS placed FROM pool""")
def _(t):
    dirty = lambda c: F.concat(F.array(F.lit("bogus")), c, c, F.array(F.lit("Rigid")))
    clean = lambda c: F.array_join(P.clean_tags(dirty(F.col(c)), F.col("junk")), ",").alias(c)
    return t.pool.select("uid", "junk", clean("anchor"), clean("placed"))


@query("p12_name_patterns", r"""
    SELECT page_id, CASE WHEN trim(regexp_extract(url, '([^/]*)/*$', 1)) IN ('.', '..') THEN ''
        ELSE regexp_replace(trim(regexp_extract(url, '([^/]*)/*$', 1)), '[^a-zA-Z0-9._-]+', '_', 'g') END AS dir_name,
      coalesce(nullif(regexp_replace(regexp_extract(url || '.GLB', '([^/\\]*)$', 1)[:-5], '[^a-zA-Z0-9._-]+', '_', 'g'), ''), 'asset') AS asset,
      page_id % 3 = 0 AS corpus, length(url) <= 128 AND regexp_matches(url, '^[~A-Za-z0-9_.:/-]+$') AS model
    FROM pages""")
def _(t):
    name = F.concat(F.when(F.col("page_id") % 3 == 0, "generated").otherwise("Generated"), F.lit("_v"), F.col("page_id"))
    return t.pages.select(
        "page_id", T.safe_dir_name(F.col("url")).alias("dir_name"),
        T.asset_base(F.concat("url", F.lit(".GLB"))).alias("asset"),
        T.is_corpus_name(name).alias("corpus"), T.is_model_id(F.col("url")).alias("model"),
    )


@query("p13_guards", """
    SELECT p_partkey, coalesce(CASE WHEN floor(p_size * 3.7::DOUBLE + 0.5) BETWEEN 4 AND 128
             THEN floor(p_size * 3.7::DOUBLE + 0.5)::BIGINT END, -1) AS resolution,
           CASE WHEN lower(p_type) IN ('small', 'large', 'promo') THEN lower(p_type) ELSE 'full' END AS mode FROM part""")
def _(t):
    return t.part.select(
        "p_partkey",
        F.coalesce(P.clamp_resolution(F.col("p_size") * 3.7), F.lit(-1)).cast("long").alias("resolution"),
        P.one_of(F.lower("p_type"), ["small", "large", "promo"], "full").alias("mode"),
    )


@query("p14_intent", f"""
    SELECT seq, coalesce(CASE WHEN seq % 5 = 0 THEN 'drape' END, CASE WHEN combined_size IS NOT NULL THEN relation END,
                         CASE WHEN complexity = 'simple' THEN context END, 'attach') AS contact FROM samples""")
def _(t):
    contact = P.intent_contact(
        F.when(F.col("seq") % 5 == 0, "drape"), F.when(P.is_placed(), F.col("relation")),
        F.when(F.col("complexity") == "simple", F.col("context")),
    )
    return t.samples.select("seq", contact.alias("contact"))


@query("p15_catalog_filter", "SELECT uid, aesthetic FROM pool WHERE list_contains(anchor, 'rigid') ORDER BY uid")
def _(t):
    return t.pool.where(F.array_contains("anchor", "rigid")).select("uid", "aesthetic").orderBy("uid")


@query("p17_drop_key", """
    SELECT event_id, event_type || '=' || event_id || ';k=' || json_extract_string(props, '$.k') AS materials FROM events""")
def _(t):
    first = F.create_map(F.col("event_type"), F.col("event_id").cast("string"), F.lit("alphaMode"), F.lit("BLEND"))
    maps = F.array(first, F.from_json("props", "map<string,string>"))
    entry = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return t.events.select("event_id", F.array_join(F.transform(P.without_key(maps, "alphaMode"), entry), ";").alias("materials"))


_NUM = lambda x: rf"regexp_replace((round({x}, 6))::DECIMAL(24,6)::VARCHAR, '\.?0+$', '')"
CONTACT_LIST = strings(D.CONTACTS)


@query("p18_report_summary", f"""
    SELECT sample_id, CASE WHEN sample_id % 10 = 0 THEN 'disabled'
        WHEN sample_id % 9 = 0 THEN 'failed, poses left as they were: degenerate'
        ELSE {CONTACT_LIST}[sample_id % 6 + 1] || ' · moved ' || {_NUM('cx')} || ' · rotated ' || {_NUM('yaw')} || '° · gap '
          || {_NUM('cy')} || ' → ' || CASE WHEN cz > 0.05 THEN '0' ELSE {_NUM('cz')} END
          || CASE WHEN pitch > 45 AND cx > 0.95 THEN ' · flags: drifted, no_contact' WHEN pitch > 45 THEN ' · flags: drifted'
                  WHEN cx > 0.95 THEN ' · flags: no_contact' ELSE '' END END AS summary FROM poses""")
def _(t):
    s = F.col("sample_id")
    contacts = F.array(*[F.lit(c) for c in D.CONTACTS])
    flags = F.array_compact(F.array(F.when(F.col("pitch") > 45, "drifted"), F.when(F.col("cx") > 0.95, "no_contact")))
    summary = L.physics_summary(
        F.get(contacts, (s % 6).cast("int")), F.col("cx"), F.col("yaw"), F.col("cy"),
        F.when(F.col("cz") <= 0.05, F.col("cz")), flags, F.when(s % 9 == 0, "degenerate"), s % 10 == 0,
    )
    return t.poses.select("sample_id", summary.alias("summary"))


@query("p19_reference_view", f"""
    WITH v AS (SELECT seq, role, CASE role WHEN 'anchor' THEN 0 ELSE floor(({uniform('az', "seq || '/' || role")} * 2 - 1) * 160 + 0.5)::BIGINT END AS azimuth,
        CASE role WHEN 'anchor' THEN 10 ELSE floor(5 + {uniform('el', "seq || '/' || role")} * 30 + 0.5)::BIGINT END AS elevation
      FROM samples, (VALUES ('anchor'), ('placed')) r(role))
    SELECT seq, role, azimuth, elevation, 'View ' || CASE WHEN azimuth = 0 THEN 'of the front'
        ELSE 'turned ' || abs(azimuth) || ' degrees to the ' || CASE WHEN azimuth > 0 THEN 'right' ELSE 'left' END END
        || ', camera ' || elevation || ' degrees up.' AS sentence
    FROM v""")
def _(t):
    rows = t.samples.select("seq", F.explode(F.array(*[F.lit(r) for r in D.ROLES])).alias("role"))
    key = F.concat_ws("/", "seq", "role")
    azimuth, elevation = P.reference_view(F.col("role"), T.md5_uniform("az", key), T.md5_uniform("el", key))
    drawn = rows.select("seq", "role", azimuth.cast("long").alias("azimuth"), elevation.cast("long").alias("elevation"))
    return drawn.withColumn("sentence", P.view_sentence(F.col("azimuth"), F.col("elevation")))


@query("p20_runs_with_two_meshes", """
    SELECT l_orderkey::VARCHAR AS folder, l_orderkey || '.glb' AS first,
           max(CASE WHEN l_linenumber > low THEN 'p' || l_partkey || '.glb' END) AS second
    FROM (SELECT *, min(l_linenumber) OVER (PARTITION BY l_orderkey) AS low FROM lines)
    GROUP BY l_orderkey HAVING count(*) = 2""")
def _(t):
    lines = t.lines.select("l_orderkey", "l_linenumber", "l_partkey")
    low = lines.groupBy("l_orderkey").agg(F.min("l_linenumber").alias("low"))
    folder = F.col("l_orderkey").cast("string")
    files = lines.join(low, "l_orderkey").select(
        folder.alias("folder"),
        F.when(F.col("l_linenumber") == F.col("low"), F.concat(folder, F.lit(".glb")))
        .otherwise(F.concat(F.lit("p"), "l_partkey", F.lit(".glb"))).alias("name"),
    )
    return S.run_meshes(files).select("folder", F.get("meshes", 0).alias("first"), F.get("meshes", 1).alias("second"))


@query("p21_staging", r"""
    SELECT page_id, ext AS extension, coalesce(lane, 'none') AS lane,
       CASE WHEN ext NOT IN ('.png', '.jpg', '.jpeg', '.webp', '.bmp') THEN 'image ignored' WHEN lane IS NULL THEN 'unknown role' ELSE 'ok' END AS verdict
    FROM (SELECT page_id, lower(regexp_extract(regexp_extract(img, '([^/\\]*)$', 1), '.(\.[^.]*)$', 1)) AS ext,
            CASE page_id % 3 WHEN 0 THEN 'geo' WHEN 1 THEN 'tex' END AS lane
          FROM (SELECT page_id, CASE WHEN page_id % 4 > 0 THEN url || ['.PNG', '.jpeg', '.gif'][page_id % 3 + 1] ELSE url END AS img FROM pages))""")
def _(t):
    role = F.get(F.array(F.lit("anchor"), F.lit("placed"), F.lit("prop")), (F.col("page_id") % 3).cast("int"))
    suffix = F.get(F.array(F.lit(".PNG"), F.lit(".jpeg"), F.lit(".gif")), (F.col("page_id") % 3).cast("int"))
    jobs = t.pages.select(
        "page_id", role.alias("role"), F.concat("url", F.when(F.col("page_id") % 4 > 0, suffix).otherwise("")).alias("image")
    )
    return P.staging(jobs).select("page_id", "extension", F.coalesce("lane", F.lit("none")).alias("lane"), "verdict")


@query("p22_last_tagged_json", """
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN doc_id ELSE -1 END AS ghost,
       md5(right(text || CASE doc_id % 3 WHEN 0 THEN chr(10) || 'GHOST {"a": 1}' || chr(10) || 'GHOST {"a": ' || doc_id || '}'
                                     WHEN 1 THEN chr(10) || 'GHOST {"a": 1' ELSE '' END, 4000)) AS tail
    FROM documents""")
def _(t):
    d = F.col("doc_id")
    tagged = F.concat(F.lit('\nGHOST {"a": 1}\nGHOST {"a": '), d.cast("string"), F.lit("}"))
    log = F.concat("text", F.when(d % 3 == 0, tagged).when(d % 3 == 1, '\nGHOST {"a": 1').otherwise(""))
    found = L.last_tagged_json(log, "GHOST", "a long")
    return t.documents.select("doc_id", F.coalesce(found["a"], F.lit(-1)).alias("ghost"), F.md5(F.right(log, F.lit(4000))).alias("tail"))


# ---- scalar functions -------------------------------------------------------------------

@query("g1_strings", rf"""
    SELECT doc_id, len({_WORDS('text')}) AS words, md5(lower(text)) AS lowered, md5({strip('text')}) AS stripped,
       md5(replace(text, 'a', ' ')) AS replaced, contains(text, ' the ') AS has_the,
       CASE WHEN length(doc_id::VARCHAR) >= 4 THEN doc_id::VARCHAR ELSE lpad(doc_id::VARCHAR, 4, '0') END AS padded
    FROM documents""")
def _(t):
    return t.documents.select(
        "doc_id", T.word_count(F.col("text")).cast("long").alias("words"), F.md5(F.lower("text")).alias("lowered"),
        F.md5(T.strip(F.col("text"))).alias("stripped"), F.md5(F.replace("text", F.lit("a"), F.lit(" "))).alias("replaced"),
        F.contains("text", F.lit(" the ")).alias("has_the"), T.pad_id(F.col("doc_id"), 4, "").alias("padded"),
    )


@query("g2_dates", """
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H-%M-%S-') || lpad((date_part('milliseconds', ts)::BIGINT % 1000)::VARCHAR, 3, '0') || 'Z' AS dashed,
           epoch_ms(date_trunc('milliseconds', ts)) AS back_ms FROM events""")
def _(t):
    dashed = T.dashed_stamp(F.col("ts"))
    back = T.from_dashed(dashed)
    seconds = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), back)
    return t.events.select("event_id", dashed.alias("dashed"), seconds.alias("back_ms"))


@query("g3_rounding", """
    SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 5) + 0.0::DOUBLE AS net,
           round(l_quantity / 7, 6) AS ratio FROM lines""")
def _(t):
    return t.lines.select(
        "l_orderkey", "l_linenumber", T.fixed(F.col("l_extendedprice") * (1 - F.col("l_discount")), 5).alias("net"),
        T.fixed(F.col("l_quantity") / 7).alias("ratio"),
    )


@query("g12_json", """
    SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, '{"k":' || json_extract(props, '$.k')::BIGINT || '}' AS text,
           event_id % 4 > 0 AS valid FROM events""")
def _(t):
    cut = F.when(F.col("event_id") % 4 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    data = F.from_json("props", "k long")
    return t.events.select("event_id", data["k"].alias("k"), F.to_json(data).alias("text"),
                           F.try_parse_json(cut).isNotNull().alias("valid"))


@query("g13_arrays", """
    SELECT vec_id, list_contains(embedding, embedding[3]) AS has, round(embedding[-1]::DOUBLE, 6) AS last,
           len(embedding[-5:]) AS tail, len(list_distinct(list_transform(embedding, lambda v: floor(v * 10)))) AS steps,
           round(list_sum(list_transform(embedding, lambda v, i: v::DOUBLE * i)), 6) + 0.0::DOUBLE AS weighted FROM embeddings""")
def _(t):
    e = F.col("embedding")
    zipped = F.arrays_zip(e.alias("v"), F.sequence(F.lit(1), F.size(e)).alias("i"))
    weighted = F.aggregate(zipped, F.lit(0.0), lambda a, p: a + p["v"].cast("double") * p["i"])
    return t.embeddings.select(
        "vec_id", F.array_contains(e, F.get(e, 2)).alias("has"), F.round(F.element_at(e, -1).cast("double"), 6).alias("last"),
        F.size(F.slice(e, -5, 5)).cast("long").alias("tail"),
        F.size(F.array_distinct(F.transform(e, lambda v: F.floor(v * 10)))).cast("long").alias("steps"),
        T.fixed(weighted).alias("weighted"),
    )
