"""One query per operator over its whole table, and the same query as SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm import sentence_pieces
from plinth.llm.byte_pairs import decode, encode
from plinth.llm.clustering import clusters, first_centroids, whole_vectors
from plinth.llm.exact_top import exact_top
from plinth.llm.fill_middle import fill_in_middle, restored
from plinth.llm.licenses import PHRASES, TEMPLATES, scan
from plinth.llm.lm import score, train
from plinth.llm.near_dups import Threshold, near_duplicates
from plinth.llm.neighbours import nearest
from plinth.llm.packing import pack, pieces
from plinth.llm.substrings import without_repeats
from plinth.llm.token_files import read_tokens, write_tokens
from plinth.llm.toxicity import toxicity
from plinth.llm.vectors import usable
from plinth.runtime import cut, scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return pack(cut(found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")), ["doc_id", "start", "ids_crc32"])


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "tokens")
    write_tokens(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_tokens(spark, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


OP3_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT doc_id, i, ws[i:i + 12] AS w FROM words, unnest(range(1, len(ws) - 11)) AS t(i)
), firsts AS (SELECT w, min(doc_id) AS d FROM windows GROUP BY w
), hits AS (
  SELECT DISTINCT doc_id, i + k AS at FROM windows JOIN firsts USING (w), unnest(range(0, 13)) AS t(k) WHERE d < doc_id
), flat AS (
  SELECT doc_id, i, ws[i] AS word FROM words, unnest(range(1, len(ws) + 1)) AS t(i)
), kept AS (
  SELECT flat.doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM flat ANTI JOIN hits ON hits.doc_id = flat.doc_id AND hits.at = flat.i GROUP BY flat.doc_id
)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(_table(spark, sf_dir, "documents"))
    base, blocks = F.col("places.label"), F.col("blocks.label")
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"), F.array_max("places.word").alias("last_word"),
        text(base).alias("base_labels"), text(F.concat(base, blocks)).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("blocks.share"), F.lit(0.0))).alias("score"),
    )


def _op4_sql() -> str:
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    split = f"regexp_extract_all(translate(%s, '{UPPER}', '{LOWER}'), '{pattern}')"
    values = lambda pairs: ", ".join(f"('{label}', '{text}')" for text, label in pairs)
    return f"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text, {split % "coalesce(text, '')"} AS ws FROM documents
), phrases AS (SELECT label, {split % "t"} AS p FROM (VALUES {values(PHRASES.items())}) v(label, t)
), templates AS (
  SELECT label, list_distinct({split % "t"}) AS tw FROM (VALUES {values((t, k) for k, t in TEMPLATES.items())}) v(label, t)
), places AS (
  SELECT doc_id, label, i - 1 AS word FROM words, phrases, unnest(range(1, len(ws) + 1)) AS r(i)
  WHERE ws[i] = p[1] AND ws[i:i + len(p) - 1] = p
), based AS (
  SELECT doc_id, count(*) AS n_base, min(word) AS first_word, max(word) AS last_word, list(label) AS base FROM places GROUP BY doc_id
), lines AS (
  SELECT doc_id, list_distinct({split % "line"}) AS b FROM words, unnest(string_split(text, chr(10))) AS l(line)
), blocks AS (
  SELECT doc_id, list(label) AS found, max(len(list_intersect(b, tw)) / len(tw)) AS share
  FROM lines, templates WHERE 5 * len(list_intersect(b, tw)) >= 4 * len(tw) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(list_distinct(coalesce(base, []::VARCHAR[]))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []::VARCHAR[]), coalesce(found, []::VARCHAR[])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0)::DOUBLE END AS score
FROM words LEFT JOIN based USING (doc_id) LEFT JOIN blocks USING (doc_id)
"""


OP4_SQL = _op4_sql()


def op5_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    coder = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    found = decode(encode(_table(spark, sf_dir, "documents"), *coder), *coder)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False)).alias("held_out")
    trie = train(docs.where(~held), scratch(spark, "lm"))
    return score(docs.select("doc_id", held, "text"), trie).withColumn("train_tokens", F.lit(trie.tokens).cast("long"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cut(usable(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", zeros=False))
    return nearest(vectors, vectors.where("id % 20 = 0"), 20)


def op8_exact_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", repeats=True)
    rows = vectors.select("id", F.transform("vector", lambda x: F.floor(x * 1024)).alias("weights"))
    return exact_top(rows, rows.where("id % 100 = 0").groupBy("id").agg(F.min("weights").alias("weights")), 10)


OP8_SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS w FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), asked AS (SELECT vec_id, min(w) AS w FROM rows WHERE vec_id % 100 = 0 GROUP BY vec_id
), scores AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.w[:least(len(q.w), len(r.w))], r.w[:least(len(q.w), len(r.w))])::BIGINT AS score
  FROM asked q JOIN rows r ON r.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= 10
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), Threshold(85, 100))


OP10_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN ws ELSE ws[i:i + 4] END AS shingle
  FROM words, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS t(i) WHERE len(ws) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(id, root) AS (
  SELECT doc_id, doc_id FROM words UNION SELECT both_ways.b, reach.root FROM reach JOIN both_ways ON reach.id = both_ways.a
), roots AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
SELECT words.doc_id, coalesce(n, 0) AS n_shingles, component_id, words.doc_id = component_id AS kept
FROM words JOIN roots ON roots.id = words.doc_id LEFT JOIN sizes ON sizes.doc_id = words.doc_id
"""

def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    found = sentence_pieces.decode(sentence_pieces.encode(_table(spark, sf_dir, "documents"), model), model)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(whole_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64, 256))
    found = clusters(rows, first_centroids(rows, 40, seed=2), rounds=5)
    return found.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )


def _op12_sql(rounds: int = 5) -> str:
    assigned = lambda centroids: f"""(
  SELECT r, vec_id, v, k, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
  FROM kept, {centroids} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)"""  # noqa: E731
    moves = "".join(f""", m{n} AS MATERIALIZED (
  SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
  FROM (SELECT k, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM {assigned(f"c{n}")}, unnest(range(1, 65)) AS t(i) GROUP BY k, i) GROUP BY k
), c{n + 1} AS MATERIALIZED (SELECT k, coalesce(m{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN m{n} USING (k))""" for n in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS k, v AS c FROM kept QUALIFY k < 40
){moves}, last AS MATERIALIZED {assigned(f"c{rounds}")}
SELECT vec_id, k::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY k)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM last JOIN c{rounds} USING (k)
"""


OP12_SQL = _op12_sql()


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(_table(spark, sf_dir, "documents"), seed=42, share=50, suffix_first=80)
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents
), drawn AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50
      THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM units
), parts AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
    array_to_string(u[greatest(a, b) + 1:], '') AS s FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_token_files": op2_token_files,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_license_scan": op4_license_scan,
    "op5_byte_pairs": op5_byte_pairs,
    "op6_lm_score": op6_lm_score,
    "op7_neighbours": op7_neighbours,
    "op8_exact_top": op8_exact_top,
    "op9_toxicity": op9_toxicity,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_sentence_pieces": op11_sentence_pieces,
    "op12_clusters": op12_clusters,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLE_SQL: dict[str, str] = {
    "op3_substring_dedup": OP3_SQL,
    "op4_license_scan": OP4_SQL,
    "op8_exact_top": OP8_SQL,
    "op10_near_duplicates": OP10_SQL,
    "op12_clusters": OP12_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
