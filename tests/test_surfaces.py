"""The nearest-triangle search and the posed bodies against plain loops."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from plinth.catalog.registry import REGISTRY
from plinth.operators import bodies as B
from plinth.operators import meshes as M
from plinth.operators import poses as PO
from plinth.operators import proximity as X
from plinth.operators import surfaces as S
from tests.conftest import SF_DIR
from tests.oracle import TABLES, compare, make_duck


def soup(rng, n):
    """Triangles of all sizes, equal ones, needles, corners in one place, and some with unknown coordinates."""
    t = (rng.standard_normal((n, 1, 3)) * 0.3 + rng.standard_normal((n, 3, 3)) * rng.choice([0.002, 0.1, 0.3], (n, 1, 1))).reshape(n, 9)
    t[1::9] = t[0::9][:len(t[1::9])]
    t[2::50, 6:] = (t[2::50, :3] + t[2::50, 3:6]) / 2
    t[3::50, 3:] = np.tile(t[3::50, :3], 2)
    t[4::50, 6:] = t[4::50, 3:6] + 1e-9
    t[5::50, 4] = np.nan
    return t


def plain(p, t, ids, limit):
    """Every pair: place, distance and witness of the nearest within the limit, ties to the smaller id."""
    d, *w = S.closest(p, t.T)
    fine = np.flatnonzero(d <= limit)
    if not len(fine):
        return -1, None, None
    best = fine[np.lexsort((ids[fine], d[fine]))[0]]
    return ids[best], d[best], [c[best] for c in w]


@pytest.mark.parametrize("n,reach,middle", [(1, 0.5, 0.0), (40, 0.05, 3.0), (900, 0.4, -1000.0), (900, 2.0, 0.0)])
def test_surface_against_every_pair(monkeypatch, n, reach, middle):
    monkeypatch.setattr(S, "PAIRS", 256)
    rng = np.random.default_rng(n)
    t, ids = soup(rng, n) + middle, rng.permutation(n) * 3
    p = np.concatenate([rng.standard_normal((400, 3)) * 0.4, rng.standard_normal((50, 3)) * 4]) + middle
    p[7], p[8:20], p[20] = [np.nan, 0.0, 0.0], t[n // 2, :3], t[0, :3]
    limit = np.where(np.arange(len(p)) % 3, reach, reach / 10)
    limit[30] = np.nan
    hit, dist, witness = S.Surface(ids, t, reach).nearest(p, limit)
    own = S.Surface(ids, t, reach).ids
    found = 0
    for i in range(len(p)):
        tri, d, w = plain(p[i], t, ids, limit[i])
        assert (own[hit[i]] if hit[i] >= 0 else -1) == tri
        if d is not None:
            found += 1
            assert dist[i] == d and witness[:, i].tolist() == w
    assert found > 0 or n == 1


def test_few_exact_distances(monkeypatch):
    """a point met every triangle near its tile, a third of the mesh and more; now a few."""
    tried, exact = [], S.closest
    monkeypatch.setattr(S, "closest", lambda p, t: (tried.append(t.shape[1]), exact(p, t))[1])
    rng = np.random.default_rng(5)
    t = (rng.standard_normal((3000, 1, 3)) * 0.1 + rng.standard_normal((3000, 3, 3)) * 0.12).reshape(-1, 9)
    p = rng.standard_normal((4000, 3)) * 0.2
    hit, _, _ = S.Surface(np.arange(3000), t, 0.4).nearest(p, np.full(4000, 0.4))
    assert (hit >= 0).mean() > 0.99 and sum(tried) < 10 * len(p)


def test_blocks_of_a_mesh(spark, monkeypatch):
    """Triangles of a mesh in many blocks give what one block gives."""
    monkeypatch.setattr(X, "stored", lambda df, tie: stored(df, tie, 100))
    from plinth.operators.parts import stored

    rng = np.random.default_rng(6)
    t, ids = soup(rng, 500), np.arange(500)
    p = rng.standard_normal((300, 3)) * 0.4
    tris = spark.createDataFrame([(3, int(i), *map(float, row)) for i, row in zip(ids, t)], "mesh_id long, tri_id long, " + ", ".join(f"{c} double" for c in M.COORDS))
    points = spark.createDataFrame([(3, i, *map(float, row)) for i, row in enumerate(p)] + [(None, 900, 0.0, 0.0, 0.0), (4, 901, 0.0, 0.0, 0.0)],
                                   "mesh_id long, point_id long, x double, y double, z double")
    grids = spark.createDataFrame([(3, 0.05)], "mesh_id long, cell double")
    got = {r["point_id"]: r for r in X.nearest_surface(points, tris, grids, 6.0).collect()}
    assert len(got) == 302 and got[900]["dist"] is None and got[901]["tri_id"] is None
    for i in range(300):
        tri, d, _w = plain(p[i], t, ids, 0.05 * 6)
        assert (got[i]["tri_id"], got[i]["dist"]) == ((tri, d) if d is not None else (None, None))


def test_no_pairs_are_shuffled(spark):
    """points and triangles were joined on tiles, ring by ring."""
    for name in ("j14_nearest_surface", "a20_minimum_gap"):
        plan = REGISTRY[name].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "tri_id" in plan and not [line for line in plan.split("\n") if "Join" in line and "cx_" in line]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """The smallest tables with null coordinates, a null id, a short vector, equal vectors and a supplier of no nation."""
    place = tmp_path_factory.mktemp("odd")
    con = duckdb.connect()
    for name in TABLES:
        if name not in ("embeddings", "supplier"):
            (place / f"{name}.parquet").symlink_to(f"{SF_DIR}/{name}.parquet")
    con.execute(f"""COPY (SELECT CASE WHEN vec_id <> 77 THEN vec_id END AS vec_id, label, CASE WHEN vec_id % 50 = 3 THEN list_concat(embedding[:61], [NULL, embedding[63], embedding[64]])
        WHEN vec_id = 8 THEN embedding[:62] WHEN vec_id % 9 = 4 THEN list_transform(embedding, lambda x, i: CASE WHEN i > 61 THEN (i - 63) / 8 ELSE x END) ELSE embedding END::FLOAT[] AS embedding
        FROM read_parquet('{SF_DIR}/embeddings.parquet')) TO '{place}/embeddings.parquet' (FORMAT parquet)""")
    con.execute(f"""COPY (SELECT s_suppkey, CASE WHEN s_suppkey <> 4 THEN s_nationkey END AS s_nationkey FROM read_parquet('{SF_DIR}/supplier.parquet'))
        TO '{place}/supplier.parquet' (FORMAT parquet)""")
    return str(place)


@pytest.mark.parametrize("name", ["g9_field_samples", "v10_toward_anchor", "v13_lowest_field", "j14_nearest_surface"])
def test_odd_bodies_match_sql(spark, odd, name):
    verdict, note, _took, _duck = compare(spark, make_duck(odd), REGISTRY[name], odd)
    assert verdict == "ok", note


def test_bodies_meet_points_in_their_task(spark):
    """Every point of every body was a row that was joined with the bricks of a field."""
    for name in ("g9_field_samples", "v10_toward_anchor", "v13_lowest_field"):
        plan = REGISTRY[name].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and not [line for line in plan.split("\n") if "Join" in line and ("point_id" in line or " bx" in line)]
        assert "values" not in plan


def test_few_points_are_sampled():
    """Where only a body's least value counts, all of its points were sampled."""
    rng = np.random.default_rng(8)
    n, cells = 20_000, np.stack(np.meshgrid(*[np.arange(24)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    phi = np.sqrt(((cells - 11.3) ** 2).sum(axis=1)) / 16 - 0.4
    grid = {"cell": 1 / 16, **{f"n{a}": 24 for a in "xyz"}, **{f"g{a}": -0.75 for a in "xyz"}}
    field = B.Field(pa.table({**{a: cells[:, i] for i, a in enumerate("xyz")}, "phi": phi, **{c: np.full(len(cells), v) for c, v in grid.items()}}))
    points = B.Points(pa.table({"point_id": np.arange(n), **{a: rng.standard_normal(n) * 0.3 for a in "xyz"}}))
    poses = {c: rng.uniform(-1, 1, (40, 1)) for c in B.POSE} | {"unknown": np.zeros((40, 1), dtype=bool)}
    length = np.sqrt(sum(poses[c] ** 2 for c in PO.ROTATION))
    poses |= {c: poses[c] / length for c in PO.ROTATION}
    least, tried = np.full(40, np.inf), 0
    for some, own, _, values in B._contenders(poses, points, field.least_near, field.sample):
        np.minimum.at(least, some, values.min(axis=1))
        tried += own.size
    every = field.sample([c.ravel() for c in B.placed(poses, points.p)], np.zeros(40 * n, dtype=bool)).reshape(40, n)
    assert (least == every.min(axis=1)).all() and tried < every.size / 3
