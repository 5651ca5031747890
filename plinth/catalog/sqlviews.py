"""The views of ``tables.py`` as SQL text, in dependency order."""

from __future__ import annotations

from plinth.operators.meshes import BOX_SIGNS, COORDS
from plinth.plans.dimensions import CATEGORIES, CATEGORY_IDS


def strings(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


IDS = strings(CATEGORY_IDS)
RELATIONS = "[" + ", ".join(strings(c[3]) for c in CATEGORIES) + "]"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def slug(x: str) -> str:
    return (
        f"coalesce(nullif(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9]+', '_', 'g'),"
        f" '^_+|_+$', '', 'g'), ''), 'object')"
    )


def r6(x: str) -> str:
    return f"round(({x})::DOUBLE, 6) + 0.0::DOUBLE"


def uniform(seed: str, key: str) -> str:
    return f"(('0x' || substr(md5('{seed}:' || ({key})::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


_LINE_ORDER = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus"
)

_BOX_SIDES = ["p_size", "(1 + p_partkey % 7)", "(1 + p_partkey % 5)"]

SQL_VIEWS: dict[str, str] = {
    "assets": f"""
        SELECT md5(doc_id::VARCHAR) AS uid, doc_id, round(n_chars::DOUBLE / 1000, 3) AS aesthetic,
               {strip('text')} AS caption, {strip("split_part(text, chr(10), 1)")} AS short, source AS license
        FROM documents""",
    "paths": "SELECT md5(page_id::VARCHAR) AS uid, url AS glb FROM pages",
    "annotations": "SELECT md5(doc_id::VARCHAR) AS uid, quality, toxic FROM labels",
    "pool": f"""
        SELECT a.uid, doc_id, aesthetic, caption, short,
               CASE WHEN quality IS NOT NULL THEN license END AS license,
               coalesce(toxic, 0) = 1 AS junk,
               [{IDS}[doc_id % 6 + 1], {IDS}[(doc_id + 2) % 6 + 1]] AS anchor,
               CASE WHEN doc_id % 3 = 0 THEN [{IDS}[doc_id % 5 + 1]] ELSE []::VARCHAR[] END AS placed
        FROM assets a LEFT JOIN annotations USING (uid)""",
    "lines": f"""
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn
          FROM lineitem) WHERE rn = 1""",
    "samples": f"""
        SELECT o_orderkey AS seq, md5(o_orderkey::VARCHAR) AS uuid, {IDS}[o_orderkey % 6 + 1] AS category,
               CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'simple'
                    WHEN substr(o_orderpriority, 1, 1) IN ('3', '4') THEN 'complex' END AS complexity,
               c_mktsegment AS context, o_orderdate AS created_at,
               {RELATIONS}[o_orderkey % 6 + 1][b.l_suppkey % len({RELATIONS}[o_orderkey % 6 + 1]) + 1] AS relation,
               a.l_partkey AS anchor_partkey, pa.p_name AS anchor_name,
               b.l_partkey AS placed_partkey, pb.p_name AS placed_name,
               pb.p_name || ' ' || {RELATIONS}[o_orderkey % 6 + 1][b.l_suppkey % len({RELATIONS}[o_orderkey % 6 + 1]) + 1]
                 || ' the ' || pa.p_name AS placement,
               CASE WHEN a.l_returnflag <> 'R' THEN {slug('pa.p_name')} || '.png' END AS anchor_image,
               CASE WHEN b.l_returnflag <> 'R' THEN {slug('pb.p_name')} || '.png' END AS placed_image,
               CASE WHEN a.l_quantity > 10 THEN {slug('pa.p_name')} || '.glb' END AS anchor_mesh,
               CASE WHEN b.l_quantity > 10 THEN {slug('pb.p_name')} || '.glb' END AS placed_mesh,
               CASE WHEN o_orderstatus = 'F' THEN a.l_quantity + b.l_quantity END AS combined_size
        FROM orders
        JOIN lines a ON a.l_orderkey = o_orderkey AND a.l_linenumber = 1
        JOIN lines b ON b.l_orderkey = o_orderkey AND b.l_linenumber = 2
        JOIN part pa ON pa.p_partkey = a.l_partkey
        JOIN part pb ON pb.p_partkey = b.l_partkey
        JOIN customer ON c_custkey = o_custkey""",
    "triangles": f"""
        SELECT label::BIGINT AS mesh_id, vec_id * 7 + k AS tri_id,
               {", ".join(f"embedding[9 * k + {i + 1}]::DOUBLE AS {c}" for i, c in enumerate(COORDS))}
        FROM embeddings, range(7) AS r(k)""",
    "points": """
        SELECT vec_id AS point_id, label::BIGINT AS mesh_id, embedding[62]::DOUBLE AS x,
               embedding[63]::DOUBLE AS y, embedding[64]::DOUBLE AS z FROM embeddings""",
    "poses": """
        SELECT l_orderkey AS sample_id, (l_suppkey % 360)::DOUBLE AS yaw, l_quantity AS pitch,
               (l_linenumber * 10)::DOUBLE AS roll, 1 + l_discount AS scale, l_quantity / 50 AS cx,
               l_tax AS cy, l_discount AS cz, l_partkey % 10 AS mesh_id
        FROM lines WHERE l_linenumber = 2""",
    "placements": """
        SELECT s_suppkey AS sample_id, s_suppkey % 10 AS mesh_id, (s_suppkey * 3 + 1) % 10 AS anchor_mesh, (s_nationkey * 15)::DOUBLE AS yaw,
               (s_suppkey % 7 * 5)::DOUBLE AS pitch, (s_suppkey % 5 * 4)::DOUBLE AS roll, (s_suppkey % 5) * 0.1::DOUBLE + 0.05::DOUBLE AS scale,
               (s_suppkey * 7 % 11) / 11::DOUBLE - 0.5::DOUBLE AS cx, (s_suppkey * 5 % 13) / 13::DOUBLE * 2.4::DOUBLE - 0.6::DOUBLE AS cy,
               (s_suppkey * 3 % 17) / 17::DOUBLE - 0.5::DOUBLE AS cz, (s_suppkey % 8 * 10)::DOUBLE AS turn,
               (s_suppkey % 6) * 0.05::DOUBLE AS slide, (s_suppkey % 9) * 0.07::DOUBLE AS fall
        FROM supplier""",
    "boxes": f"""
        SELECT p_partkey AS mesh_id, k AS tri_id,
               {", ".join(f'"{c}" * {_BOX_SIDES[i % 3]}::DOUBLE AS "{c}"' for i, c in enumerate(COORDS))}
        FROM part, (VALUES {", ".join("(" + ", ".join(str(v) for v in (k, *signs)) + ")" for k, signs in enumerate(BOX_SIGNS))})
          AS f(k, {", ".join(f'"{c}"' for c in COORDS)})""",
}
