"""Meshes, voxels and proximity on shapes with known answers."""

import json
import math
import struct
from collections import deque

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plinth.catalog.q_files import encode_glb
from plinth.catalog.tables import Tables
from plinth.operators import meshes as M
from plinth.operators import poses as PO
from plinth.operators import proximity as X
from plinth.operators import voxels as V
from plinth.sources import glb
from tests.conftest import SF_DIR


def boxes(spark, specs):
    """Triangles of ``(mesh_id, centre, size)`` boxes; several rows may share a mesh."""
    rows = [(n, m, *c, *s) for n, (m, c, s) in enumerate(specs)]
    sized = spark.createDataFrame(rows, "part long, mesh_id long, ox double, oy double, oz double, sx double, sy double, sz double")
    unit = M.box_triangles(sized.select(F.col("part").alias("mesh_id"), "sx", "sy", "sz")).withColumnRenamed("mesh_id", "part")
    joined = unit.join(sized.select("part", "mesh_id", "ox", "oy", "oz"), "part")
    return joined.select(
        "mesh_id", (F.col("part") * 100 + F.col("tri_id")).alias("tri_id"),
        *[(F.col(c) + F.col("o" + c[1])).alias(c) for c in M.COORDS])


CUBE = (1, (0.0, 0.0, 0.0), (1.0, 1.0, 1.0))
OPEN = [(2, (0.0, -0.45, 0.0), (1.0, 0.1, 1.0)), (2, (-0.45, 0.05, 0.0), (0.1, 0.9, 1.0)), (2, (0.45, 0.05, 0.0), (0.1, 0.9, 1.0)),
        (2, (0.0, 0.05, -0.45), (0.8, 0.9, 0.1)), (2, (0.0, 0.05, 0.45), (0.8, 0.9, 0.1))]


@pytest.fixture(scope="module")
def shapes(spark):
    return boxes(spark, [CUBE, *OPEN]).cache()


def test_cube_measures(shapes):
    row = M.bounds(shapes).where("mesh_id = 1").first()
    assert (row["minx"], row["maxy"], row["sizez"]) == (-0.5, 0.5, 1.0)
    assert M.surface_area(shapes).where("mesh_id = 1").first()["area"] == pytest.approx(6.0)


def test_solids_and_open_cavity(shapes):
    cells = V.solid_cells(shapes, V.grid_headers(shapes, 10)).collect()
    cube = {(r["x"], r["y"], r["z"]) for r in cells if r["mesh_id"] == 1}
    cup = {(r["x"], r["y"], r["z"]) for r in cells if r["mesh_id"] == 2}
    assert len(cube) == 1000
    assert (5, 5, 5) not in cup and (5, 0, 5) in cup and (0, 5, 5) in cup


def test_fill_equals_breadth_first(spark):
    rng = np.random.default_rng(5)
    grids = rng.random((4, 6, 7, 5)) < 0.5
    rows = [(m, int(x), int(y), int(z)) for m in range(4) for x, y, z in np.argwhere(grids[m])]
    headers = spark.createDataFrame([(m, 6, 7, 5) for m in range(4)], "mesh_id long, nx int, ny int, nz int")
    got = V.filled_cells(spark.createDataFrame(rows, "mesh_id long, x int, y int, z int"), headers).collect()
    for m in range(4):
        wall, out = grids[m], set()
        todo = deque(p for p in np.ndindex(6, 7, 5) if not wall[p] and (0 in p or p[0] == 5 or p[1] == 6 or p[2] == 4))
        while todo:
            p = todo.popleft()
            if p in out:
                continue
            out.add(p)
            for a in range(3):
                for d in (-1, 1):
                    q = tuple(p[i] + d * (i == a) for i in range(3))
                    if all(0 <= q[i] < (6, 7, 5)[i] for i in range(3)) and not wall[q]:
                        todo.append(q)
        assert {(r["x"], r["y"], r["z"]) for r in got if r["mesh_id"] == m} == set(np.ndindex(6, 7, 5)) - out


def test_blocks_are_disjoint_and_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(m, int(x), int(y), int(z)) for m in range(3) for x, y, z in np.argwhere(rng.random((5, 4, 6)) < 0.6)]
    found = V.blocks(spark.createDataFrame(rows, "mesh_id long, x int, y int, z int")).collect()
    covered = [(b["mesh_id"], x, y, z) for b in found for x in range(b["x0"], b["x1"]) for y in range(b["y0"], b["y1"]) for z in range(b["z0"], b["z1"])]
    assert sorted(covered) == sorted(rows)
    for m in range(3):
        volumes = [b["volume"] for b in sorted((b for b in found if b["mesh_id"] == m), key=lambda b: b["rank"])]
        assert volumes == sorted(volumes, reverse=True)


def test_distance_field_of_a_cube(spark, shapes):
    cube = shapes.where("mesh_id = 1")
    phi, headers = V.distance_field(cube, 16)
    points = spark.createDataFrame([(1, 1, 0.0, 0.58, 0.0), (1, 2, 0.0, 0.0, 0.0), (1, 3, 0.0, 5.0, 0.0)], "mesh_id long, point_id long, x double, y double, z double")
    got = {r["point_id"]: r for r in X.field_gradient(points, X.field_bricks(phi, headers), headers).collect()}
    assert got[1]["phi"] == pytest.approx(0.08, abs=0.07) and got[1]["grady"] > 0.9
    assert got[2]["phi"] < -0.4 and got[3]["phi"] > 3.5


def closest(p, a, b, c):
    """Distance of a point to a triangle, by its plane and its three edges."""
    n = np.cross(b - a, c - a)
    out = []
    if (size := np.linalg.norm(n)) > 0:
        q = p - n * (np.dot(p - a, n) / size**2)
        if all(np.dot(np.cross(v - u, q - u), n) >= 0 for u, v in ((a, b), (b, c), (c, a))):
            out.append(np.linalg.norm(p - q))
    for u, v in ((a, b), (b, c), (c, a)):
        t = np.clip(np.dot(p - u, v - u) / max(np.dot(v - u, v - u), 1e-300), 0, 1)
        out.append(np.linalg.norm(p - u - t * (v - u)))
    return min(out)


@pytest.mark.parametrize("cells", [1.0, 6.0])
def test_nearest_surface_against_brute_force(spark, shapes, cells):
    """Points inside, near and far, on grids of two sizes: exact within reach, null beyond."""
    rng = np.random.default_rng(1)
    size = {1: 0.05, 2: 0.11}
    pts = [(m, s, s * 1000 + i, *map(float, rng.uniform(-w, w, 3))) for m in (1, 2) for s, w in ((m, 0.7), (m + 5, 3.0)) for i in range(40)]
    pts += [(1, 1, -1, None, 0.0, 0.0), (9, 1, -2, 0.0, 0.0, 0.0)]
    points = spark.createDataFrame(pts, "mesh_id long, sample_id long, point_id long, x double, y double, z double")
    grids = spark.createDataFrame(list(size.items()), "mesh_id long, cell double")
    got = {r["point_id"]: r for r in X.nearest_surface(points, shapes, grids, cells, ["sample_id", "point_id"]).collect()}
    assert len(got) == len(pts) and got.pop(-1)["dist"] is None and got.pop(-2)["dist"] is None
    tris = {m: [[np.array([r[v + a] for a in "xyz"]) for v in "abc"] for r in shapes.collect() if r["mesh_id"] == m] for m in (1, 2)}
    hits = 0
    for m, _s, i, *p in pts[:-2]:
        best = min(closest(np.array(p), *t) for t in tris[m])
        if best <= size[m] * cells:
            hits += 1
            assert got[i]["dist"] == pytest.approx(best, abs=1e-12)
            assert np.linalg.norm(np.array([got[i][f"w{a}"] for a in "xyz"]) - p) == pytest.approx(best, abs=1e-12)
        else:
            assert got[i]["dist"] is None and got[i]["tri_id"] is None
    assert hits > (5 if cells == 1.0 else 20)


def test_rings_double_until_the_reach_is_covered():
    assert X.rings(6.0) == pytest.approx([2, 4, 6], rel=1e-6) and X.rings(6.0)[-1] > 6
    assert X.rings(1.0) == pytest.approx([1]) and X.rings(16.0) == pytest.approx([2, 4, 8, 16], rel=1e-6)


@pytest.mark.parametrize("n,m,share", [(1, 5, 0.5), (2, 3, 0.5), (17, 40, 0.2), (60, 30, 0.02), (33, 8, 0.0)])
def test_envelope(n, m, share):
    rng = np.random.default_rng(n)
    f = np.where(rng.random((n, m)) < share, rng.integers(0, 3, (n, m)) * rng.integers(0, n * n + 1, (n, m)), V.FAR)
    q = np.arange(n)
    plain = np.minimum(((q[:, None, None] - q[None, :, None]) ** 2 + f[None]).min(axis=1), V.FAR)
    assert (V.envelope(f) == plain).all()
    site = rng.random((m, n)) < share
    near = np.array([[min([(a - b) ** 2 for b in range(n) if row[b]], default=V.FAR) for a in range(n)] for row in site])
    assert (V.nearest_site(site) == near).all()


def test_envelope_is_linear():
    """Comparisons per cell do not grow with the length of a line."""
    import time

    rng = np.random.default_rng(3)
    spent = []
    for n in (48, 384):
        f = np.where(rng.random((n, 60_000 // n * 8)) < 0.1, 0, V.FAR)
        V.envelope(f)
        start = time.process_time()
        V.envelope(f)
        spent.append((time.process_time() - start) / f.size)
    assert spent[1] < 3 * spent[0]  # the square would be 8 times


def test_distance_field_against_brute_force(spark):
    """Random solids in grids of different sides, one of them with a whole empty slab and one nearly full."""
    rng = np.random.default_rng(6)
    grids = {0: rng.random((7, 9, 5)) < 0.1, 1: rng.random((6, 4, 11)) < 0.5, 2: rng.random((12, 3, 8)) < 0.97}
    grids[0][:, 4, :] = False
    rows = [(m, int(y), int(z), int(x), int(x)) for m, g in grids.items() for x, y, z in np.argwhere(g)]
    headers = spark.createDataFrame([(m, 0.5 + m, *g.shape) for m, g in grids.items()], "mesh_id long, cell double, nx int, ny int, nz int")
    found = V.signed_distance(spark.createDataFrame(rows, "mesh_id long, y int, z int, x0 int, x1 int"), headers).collect()
    assert len(found) == sum(g.size for g in grids.values())
    for m, g in grids.items():
        solid, empty = np.argwhere(g), np.argwhere(~g)
        for r in (r for r in found if r["mesh_id"] == m):
            p = np.array([r["x"], r["y"], r["z"]])
            far = np.sqrt((((empty if g[tuple(p)] else solid) - p) ** 2).sum(axis=1).min()) * (0.5 + m)
            assert r["phi"] == pytest.approx(-far if g[tuple(p)] else far)


def test_fill_of_a_spiral_and_a_sealed_box(spark):
    """A long winding corridor that is open at its end, and the same one closed there."""
    n = 15
    wall = np.ones((n, n), dtype=bool)
    x = y = 0
    dx, dy, path = 1, 0, [(0, 0)]
    wall[0, 0] = False
    for _ in range(400):
        ax, ay = x + 2 * dx, y + 2 * dy
        if not (0 <= ax < n and 0 <= ay < n) or not wall[ax, ay]:
            dx, dy = -dy, dx
            ax, ay = x + 2 * dx, y + 2 * dy
            if not (0 <= ax < n and 0 <= ay < n) or not wall[ax, ay]:
                break
        for _step in range(2):
            x, y = x + dx, y + dy
            wall[x, y] = False
            path.append((x, y))
    rows, size = [], n + 2
    for m, shut in ((0, False), (1, True)):
        for px in range(size):
            for py in range(size):
                for pz in range(3):
                    inner = 1 <= px <= n and 1 <= py <= n and pz == 1
                    free = inner and not wall[px - 1, py - 1] or (px, py, pz) == (1, 0, 1) and not shut
                    if not free:
                        rows.append((m, px, py, pz))
    headers = spark.createDataFrame([(m, size, size, 3) for m in (0, 1)], "mesh_id long, nx int, ny int, nz int")
    got = V.filled_cells(spark.createDataFrame(rows, "mesh_id long, x int, y int, z int"), headers).collect()
    assert len(path) > 90
    assert sum(r["mesh_id"] == 0 for r in got) == size * size * 3 - len(path) - 1
    assert sum(r["mesh_id"] == 1 for r in got) == size * size * 3


def test_components(spark):
    from plinth.operators.components import GROUND, grounded_labels

    rng = np.random.default_rng(4)
    nodes = [(k, i, bool(i == 0 and k == 1 or i == 77)) for k in (1, 2) for i in range(150)]
    edges = [(k, i, i + 1) for k in (1, 2) for i in range(60)] + [(k, *map(int, rng.integers(61, 150, 2))) for k in (1, 2) for _ in range(60)] + [(1, 5, 5)]
    root = {(k, i): (k, i) for k, i, _ in nodes}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for k, a, b in edges:
        x, y = sorted((find((k, a)), find((k, b))))
        root[y] = x
    seeds = {find((k, i)) for k, i, s in nodes if s}
    expected = {(k, i): GROUND if find((k, i)) in seeds else find((k, i))[1] for k, i, _ in nodes}
    got = grounded_labels(spark.createDataFrame(nodes, "k long, id long, seed boolean"), spark.createDataFrame(edges, "k long, a long, b long"), ["k"])
    assert {(r.k, r.id): r.label for r in got.collect()} == expected
    assert grounded_labels(spark.createDataFrame([], "k long, id long, seed boolean"), spark.createDataFrame([], "k long, a long, b long"), ["k"]).count() == 0


def test_hot_keys_are_split_by_their_counts(spark):
    from plinth.operators.skew import salted_join

    left = spark.range(700).selectExpr("if(id < 400, 1, id) AS k", "id AS l")
    right = spark.range(300).selectExpr("if(id < 200, 1, id + 300) AS k", "id AS r")
    plain = sorted(map(tuple, left.join(right, "k").collect()))
    for block in (7, 50, 4096):
        assert sorted(map(tuple, salted_join(left, right, ["k"], "l", "r", block).collect())) == plain


def test_contact_of_a_small_cube_over_a_large_one(spark):
    """Known answers: a gap of 0.03, a burial, a slide, a long fall past the anchor; lengths over an anchor of side 2."""
    cube = boxes(spark, [(1, (0.0, 0.0, 0.0), (2.0, 2.0, 2.0))])
    corners = [(sx, sy, sz) for sx in (-0.1, 0.0, 0.1) for sy in (-0.1, 0.1) for sz in (-0.1, 0.0, 0.1)]
    centre = {1: (0.0, 1.16, 0.0), 2: (0.0, 0.5, 0.0), 3: (0.0, 1.16, 0.0), 4: (2.5, 1.16, 0.0), 5: (0.0, 1.05, 0.0)}
    shift = {1: (0.0, -0.06, 0.0), 2: (0.0, -0.1, 0.0), 3: (0.9, -0.06, 0.0), 4: (0.0, -1.4, 0.0), 5: (0.0, 0.0, 0.0)}
    turn = {1: 5.0, 2: 0.0, 3: 0.0, 4: 0.0, 5: 70.0}
    rows = [(s, 1, i, *[c + o for c, o in zip(centre[s], p)]) for s in centre for i, p in enumerate(corners)]
    later = [(s, m, i, *[c + d for c, d in zip((x, y, z), shift[s])]) for s, m, i, x, y, z in rows]
    schema = "sample_id long, mesh_id long, point_id long, x double, y double, z double"
    turned = spark.createDataFrame([(s, 1, t) for s, t in turn.items()], "sample_id long, mesh_id long, rotated double")
    phi, headers = V.distance_field(cube, 20)
    found = X.contact_table(spark.createDataFrame(rows, schema), spark.createDataFrame(later, schema), cube, X.field_bricks(phi, headers), headers, turned)
    got = {r["sample_id"]: r for r in found.collect()}
    radius = math.sqrt(0.03) / 2
    assert got[1]["gap"] == pytest.approx(0.03) and got[1]["gap_after"] == pytest.approx(0.0, abs=0.026) and got[1]["flags"] == []
    assert got[1]["moved"] == pytest.approx(0.03) and got[1]["rotated"] == 5.0 and got[1]["depth"] == 0 and got[1]["radius"] == pytest.approx(radius)
    assert got[2]["flags"] == ["deep_penetration"] and got[2]["depth"] > radius and got[2]["moved"] == 0 and got[2]["gap_after"] == got[2]["gap"] < -radius
    assert got[3]["flags"] == ["drifted"] and got[3]["drift"] == pytest.approx(0.45) and got[3]["moved"] == 0
    assert got[4]["flags"] == ["dropped_far"] and got[4]["drop"] == pytest.approx(0.7) and got[4]["moved"] == pytest.approx(0.7)
    assert got[5]["flags"] == ["drifted"] and got[5]["rotated"] == 0 and got[5]["gap"] < 0.0


def sphere(r=0.5, stacks=24, slices=48):
    at = lambda i, j: (r * math.sin(math.pi * i / stacks) * math.cos(2 * math.pi * j / slices), r * math.cos(math.pi * i / stacks),
                       r * math.sin(math.pi * i / stacks) * math.sin(2 * math.pi * j / slices))
    points = [at(i, j) for i in range(stacks + 1) for j in range(slices)]
    index = []
    for i in range(stacks):
        for j in range(slices):
            a, b, c, d = i * slices + j, (i + 1) * slices + j, (i + 1) * slices + (j + 1) % slices, i * slices + (j + 1) % slices
            index += ([a, b, d] if i else []) + ([b, c, d] if i < stacks - 1 else [])
    return points, index


def indexed_glb(points, index, **extra):
    data = np.array(points, "<f4").tobytes() + np.array(index, "<u2").tobytes()
    primitive = {"attributes": {"POSITION": 0}, "indices": 1, **extra.get("primitive", {})}
    doc = {"scenes": [{"nodes": [0]}], "nodes": [{"children": [1], "translation": [1, 0, 0]}, {"mesh": 0, "scale": [2, 2, 2]}], "meshes": [{"primitives": [primitive]}],
           "accessors": [{"bufferView": 0, "componentType": 5126, "count": len(points), "type": "VEC3", **extra.get("accessor", {})},
                         {"bufferView": 1, "componentType": 5123, "count": len(index), "type": "SCALAR"}],
           "bufferViews": [{"byteOffset": 0}, {"byteOffset": 12 * len(points)}], **extra.get("doc", {})}
    head = json.dumps(doc).encode()
    head += b" " * (-len(head) % 4)
    parts = struct.pack("<II", len(head), glb.JSON_CHUNK) + head + struct.pack("<II", len(data), glb.BIN_CHUNK) + data
    return struct.pack("<III", glb.MAGIC, 2, 12 + len(parts)) + parts


def test_mesh_files(spark, tmp_path):
    points, index = sphere()
    draco = {"extensions": {"KHR_draco_mesh_compression": {}}}
    files = {"sphere": indexed_glb(points, index), "draco": indexed_glb(points, index, primitive=draco), "lines": indexed_glb(points, index, primitive={"mode": 1}),
             "sparse": indexed_glb(points, index, accessor={"sparse": {}}), "bare": indexed_glb(points, index, doc={"scenes": []}), "text": b"hello world, not a mesh",
             "posed": encode_glb(np.zeros((1, 9)), {"name": glb.POSED_NODE, "scale": [2.0, 2.0, 2.0]})}
    for name, content in files.items():
        (tmp_path / f"{name}.glb").write_bytes(content)
    rows = glb.mesh_rows(glb.mesh_files(spark, str(tmp_path))).cache()
    reasons = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in glb.errors(rows).collect()}
    assert set(reasons) == {"draco.glb", "lines.glb", "sparse.glb", "bare.glb", "text.glb"}
    ball = glb.triangles(rows).where("path like '%sphere%'").withColumn("mesh_id", F.lit(1))
    assert M.surface_area(ball).first()["area"] == pytest.approx(4 * math.pi, rel=0.01)
    assert M.bounds(ball).first()["midx"] == pytest.approx(1.0, abs=1e-6)
    flags = {r["path"].rsplit("/", 1)[1]: r for r in glb.posed(glb.scene_roots(glb.mesh_files(spark, str(tmp_path)))).collect()}
    assert flags["posed.glb"]["posed"] and flags["posed.glb"]["scale"] == [2.0, 2.0, 2.0] and not flags["sphere.glb"]["posed"]


def test_surface_points_follow_area(spark, shapes):
    slab = boxes(spark, [(7, (0.0, 0.0, 0.0), (4.0, 0.01, 1.0)), (7, (0.0, 3.0, 0.0), (1.0, 0.01, 1.0))])
    got = M.surface_points(slab, 400).agg(F.count_if(F.col("y") < 1).alias("low")).first()["low"]
    assert 285 < got < 355  # four fifths of the area


def test_order_with_null_keys_and_values(spark):
    from plinth.operators.joins import as_of
    from plinth.operators.ordering import ranked
    from plinth.operators.windows import islands

    feed = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, None), ("a", 3, 5), ("a", None, 5), (None, 1, 1), (None, 2, 1)], "k string, t long, v long"
    )
    got = {(r.k, r.t): r.island for r in islands(feed, ["k"], ["t"], "v").collect()}
    assert got == {("a", None): 1, ("a", 1): 1, ("a", 2): 2, ("a", 3): 3, (None, 1): 1, (None, 2): 1}
    many = spark.range(500).selectExpr("id", "if(id % 7 = 0, null, id) AS o")
    ranks = [r.rn for r in ranked(many, ["o", "id"]).orderBy("o", "id").collect()]
    assert ranks == list(range(1, 501))
    left = spark.createDataFrame([("a", 4, 1), ("b", 4, 1), (None, 4, 2), ("a", None, 3)], "k string, t long, id long")
    right = spark.createDataFrame([("a", 1, 5.0, 7), ("a", 2, None, 8), ("b", 3, 6.0, 9), ("a", 4, 9.0, 1)], "k string, t long, v double, id long")
    found = {(r.k, r.t): r.v for r in as_of(left, right, "k", "t", "v", "id").collect()}
    assert found == {("a", 4): None, ("b", 4): 6.0, (None, 4): None, ("a", None): None}


def test_mesh_files_leave_a_task_in_pieces():
    box = np.arange(12 * 9, dtype=float).reshape(12, 9)
    whole, broken = encode_glb(box, {"name": "root"}), b"plain text"
    files = pa.RecordBatch.from_pydict({"path": [f"/{i}.glb" for i in range(5000)], "content": [broken if i % 10 == 0 else whole for i in range(5000)]})
    out = list(glb._read(iter([files])))
    assert max(b.num_rows for b in out) <= glb.PIECE + 12
    rows = pa.Table.from_batches(out).to_pandas()
    assert rows["error"].notna().sum() == 500 and rows["error"].isna().sum() == 4500 * 12
    one = rows[rows["path"] == "/7.glb"]
    assert list(one["tri_id"]) == list(range(12)) and (one[M.COORDS].to_numpy() == box).all()


def test_boxes_are_dealt_before_they_unfold(spark):
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert Tables(spark, SF_DIR).boxes.rdd.getNumPartitions() == dealt


def test_applied_poses_equal_a_loop_over_corners(spark, monkeypatch):
    """sums come without a row per pose and triangle; only poses that may not be undone meet the triangles."""
    rng = np.random.default_rng(5)
    points = {1: rng.normal(size=(40, 3)), 2: rng.normal(size=(7, 3)) * 1000, 4: rng.normal(size=(3, 3))}
    corners = [(m, i, *map(float, p)) for m, rows in points.items() for i, p in enumerate(rows)]
    corners += [(1, 90, None, 1.0, 1.0), (3, 0, None, 0.0, 0.0), (4, 9, float("nan"), 0.0, 0.0)]
    names = "sample_id long, mesh_id long, cx double, cy double, cz double, qx double, qy double, qz double, qw double, scale double"
    q = rng.normal(size=4)
    q /= np.linalg.norm(q)
    poses = [(n, n % 5, *map(float, rng.normal(size=3)), *map(float, q * k), 0.5 + n) for n, k in enumerate([1.0] * 10 + [1.1] * 5 + [1 + 1e-12] * 5 + [1 + 2e-10] * 5)]
    poses += [(70, 1, 1e9, 0.0, 0.0, *map(float, q), 1.0), (71, 1, 0.0, None, 0.0, *map(float, q), 1.0)]
    met, whole = [], M.pose_meshes
    monkeypatch.setattr(M, "pose_meshes", lambda parts, held: met.append(sorted(r.sample_id for r in held.collect())) or whole(parts, held))
    triangles = spark.createDataFrame(corners, "mesh_id long, tri_id long, ax double, ay double, az double")
    got = {r.sample_id: r for r in PO.applied(triangles, spark.createDataFrame(poses, names)).collect()}
    assert sorted(got) == sorted(p[0] for p in poses if p[1])

    def turn(v, u, w):
        t = 2 * np.cross(u, v)
        return v + w * t + np.cross(u, t)

    for sample, mesh, *rest in poses:
        if mesh in (0, 3) or None in rest:
            assert not mesh or got[sample].undone and got[sample].triangles == sum(c[0] == mesh for c in corners)
            continue
        c, u, w, k = np.array(rest[:3]), np.array(rest[3:6]), rest[6], rest[7]
        own = np.array([p[2:] for p in corners if p[0] == mesh and p[2] is not None])
        moved = turn(own * k, u, w) + c
        off = np.abs(turn(moved - c, -u, w) / k - own).max()
        assert got[sample].triangles == sum(p[0] == mesh for p in corners)
        assert np.allclose([got[sample][f"sum{a}"] for a in "xyz"], moved.sum(axis=0), rtol=1e-9, atol=1e-9 * (1 + abs(c).max()), equal_nan=True)
        assert got[sample].undone == bool(off < 1e-9)
    assert len(met) == 1 and not set(met[0]) & {1, 6, 11 + 5} and {70, 11, 4} <= set(met[0])
    plan = PO.applied(triangles, spark.createDataFrame(poses[:4], names))._jdf.queryExecution().executedPlan().toString()
    assert len(met) == 1 and "Join" not in plan
