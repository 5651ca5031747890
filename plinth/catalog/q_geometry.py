"""Geometry queries: rotations, poses, bounds, areas, normals, surface samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from plinth.catalog.registry import query
from plinth.catalog.sqlviews import SQL_VIEWS, r6, uniform
from plinth.functions import text as T
from plinth.functions import vectors as G
from plinth.operators import filters as P
from plinth.operators import meshes as M
from plinth.operators import poses as PO

_HALF = {"p": "radians(pitch) / 2", "y": "radians(yaw) / 2", "r": "radians(roll) / 2"}
_S = {k: f"sin({v})" for k, v in _HALF.items()}
_C = {k: f"cos({v})" for k, v in _HALF.items()}
SQL_VIEWS["rotations"] = f"""
    SELECT *, {_S['p']} * {_C['y']} * {_C['r']} + {_C['p']} * {_S['y']} * {_S['r']} AS qx,
      {_C['p']} * {_S['y']} * {_C['r']} - {_S['p']} * {_C['y']} * {_S['r']} AS qy,
      {_C['p']} * {_C['y']} * {_S['r']} - {_S['p']} * {_S['y']} * {_C['r']} AS qz,
      {_C['p']} * {_C['y']} * {_C['r']} + {_S['p']} * {_S['y']} * {_S['r']} AS qw FROM poses"""


def matrix(q="q", p="m"):
    """Rotation matrix columns of a quaternion as SQL."""
    x, y, z, w = (q + a for a in "xyzw")
    rows = [
        (f"1 - 2 * ({y}*{y} + {z}*{z})", f"2 * ({x}*{y} - {z}*{w})", f"2 * ({x}*{z} + {y}*{w})"),
        (f"2 * ({x}*{y} + {z}*{w})", f"1 - 2 * ({x}*{x} + {z}*{z})", f"2 * ({y}*{z} - {x}*{w})"),
        (f"2 * ({x}*{z} - {y}*{w})", f"2 * ({y}*{z} + {x}*{w})", f"1 - 2 * ({x}*{x} + {y}*{y})"),
    ]
    return ", ".join(f"{e} AS {p}{i}{j}" for i, row in enumerate(rows) for j, e in enumerate(row))


def turned(v, back=False, p="m"):
    """Three SQL expressions of matrix times vector (or its transpose)."""
    return [" + ".join(f"{p}{j}{i} * ({v[j]})" if back else f"{p}{i}{j} * ({v[j]})" for j in range(3)) for i in range(3)]


SQL_VIEWS["turns"] = f"SELECT *, {matrix()} FROM rotations"
CTR = ["cx", "cy", "cz"]


@query("g4_euler_quaternion", f"SELECT sample_id, {r6('qx')} AS qx, {r6('qy')} AS qy, {r6('qz')} AS qz, {r6('qw')} AS qw FROM rotations")
def _(t):
    return PO.with_rotation(t.poses).select("sample_id", *[T.fixed(F.col(n)).alias(n) for n in PO.ROTATION])


_F, _B = turned(CTR), turned(CTR, back=True)
# Product with the fixed half turn (0.6, 0, 0.8, 0): left factor is the pose.
_PROD = ["qw * 0.6 + qy * 0.8 - qz * 0", "qz * 0.6 - qx * 0.8", "qw * 0.8 + qx * 0 - qy * 0.6", "- qx * 0.6 - qz * 0.8"]


@query("g5_quaternion_algebra", f"""
    SELECT sample_id, {", ".join(f"{r6(e)} AS f{a}" for e, a in zip(_F, "xyz"))}, {", ".join(f"{r6(e)} AS b{a}" for e, a in zip(_B, "xyz"))},
       {", ".join(f"{r6(e)} AS p{a}" for e, a in zip(_PROD, "xyzw"))}, {r6('degrees(2 * acos(least(1, abs(qw))))')} AS angle FROM turns""")
def _(t):
    rows = PO.with_rotation(t.poses)
    q, v = PO.quaternion(), G.vec("c")
    stretched = tuple(c * 3.0 for c in q)
    half_turn = tuple(F.lit(x) for x in (0.6, 0.0, 0.8, 0.0))
    product = G.multiply(G.normalised(stretched), half_turn)
    return rows.select(
        "sample_id", *[T.fixed(c).alias(f"f{a}") for c, a in zip(G.rotate(q, v), "xyz")],
        *[T.fixed(c).alias(f"b{a}") for c, a in zip(G.rotate_back(q, v), "xyz")],
        *[T.fixed(c).alias(f"p{a}") for c, a in zip(product, "xyzw")], T.fixed(G.angle_degrees(q)).alias("angle"),
    )


_CORNER = turned(["ax * scale", "ay * scale", "az * scale"])


@query("g6_apply_pose", f"""
    SELECT sample_id, count(*) AS triangles, {", ".join(f"round(sum({e} + turns.{c}), 5) + 0.0::DOUBLE AS sum{a}" for e, c, a in zip(_CORNER, CTR, "xyz"))}, true AS undone
    FROM turns JOIN triangles USING (mesh_id) GROUP BY sample_id""")
def _(t):
    moved = PO.applied(t.triangles, PO.with_rotation(t.poses))
    return moved.select("sample_id", "triangles", *[(F.round(f"sum{a}", 5) + F.lit(0.0)).alias(f"sum{a}") for a in "xyz"], "undone")


_EXTREMES = ", ".join(f'min(least(a{a}, "b{a}", c{a})) AS min{a}, max(greatest(a{a}, "b{a}", c{a})) AS max{a}' for a in "xyz")
SQL_VIEWS["mesh_bounds"] = f"""
    SELECT *, {", ".join(f"(min{a} + max{a}) / 2 AS mid{a}, max{a} - min{a} AS size{a}" for a in "xyz")}
    FROM (SELECT mesh_id, {_EXTREMES} FROM triangles GROUP BY mesh_id)"""
SQL_VIEWS["box_bounds"] = SQL_VIEWS["mesh_bounds"].replace("triangles", "boxes")
_MID = turned([f"b.mid{a} * scale" for a in "xyz"])
SQL_VIEWS["resolved"] = f"""
    SELECT sample_id, t.mesh_id, a.mesh_id AS anchor_mesh, {", ".join(f"{r6(f'-a.mid{a}')} AS anchor_p{a}" for a in "xyz")},
      {", ".join(f"{r6(f'{c} - ({e})')} AS p{a}" for c, e, a in zip(CTR, _MID, "xyz"))},
      {", ".join(f"{r6(f'q{a}')} AS q{a}" for a in "xyzw")}, {r6('scale')} AS scale
    FROM turns t JOIN mesh_bounds b ON b.mesh_id = t.mesh_id JOIN mesh_bounds a ON a.mesh_id = (t.mesh_id + 1) % 10"""


def resolved(t):
    answers = t.poses.withColumn("anchor_mesh", (F.col("mesh_id") + 1) % 10)
    return PO.resolve(answers, M.bounds(t.triangles))


_POSE_COLUMNS = [*[f"anchor_p{a}" for a in "xyz"], *PO.POSITION, *PO.ROTATION, "scale"]


@query("g7_resolve_pose", f"SELECT sample_id, {', '.join(_POSE_COLUMNS)} FROM resolved")
def _(t):
    return resolved(t).select("sample_id", *_POSE_COLUMNS)


SQL_VIEWS["role_poses"] = f"""
    SELECT sample_id, role, r.mesh_id, px, py, pz, scale, {matrix()} FROM (
      SELECT sample_id, 'anchor' AS role, anchor_mesh AS mesh_id, anchor_px AS px, anchor_py AS py, anchor_pz AS pz, 0 AS qx, 0 AS qy, 0 AS qz, 1 AS qw, 1 AS scale FROM resolved
      UNION ALL SELECT sample_id, 'placed', mesh_id, px, py, pz, qx, qy, qz, qw, scale FROM resolved) r"""


def _moved_box(source, corners):
    moved = {c: turned([f'"{c}{a}" * scale' for a in "xyz"]) for c in corners}
    parts = []
    for i, a in enumerate("xyz"):
        values = ", ".join(f"{moved[c][i]} + p{a}" for c in corners)
        parts.append(f"min(least({values})) AS min{a}, max(greatest({values})) AS max{a}")
    return f"SELECT sample_id, role, {', '.join(parts)} FROM role_poses JOIN {source} USING (mesh_id) GROUP BY sample_id, role"


SQL_VIEWS["posed_boxes"] = _moved_box("triangles", "abc")


@query("a10_posed_sizes", f"""
    SELECT sample_id, {", ".join(f"{r6(f'''max(max{a} - min{a}) FILTER (role = '{r}')''')} AS {r}_{a}" for r in ("anchor", "placed") for a in "xyz")},
      {", ".join(f"{r6(f'max(max{a}) - min(min{a})')} AS combined_{a}" for a in "xyz")} FROM posed_boxes GROUP BY sample_id""")
def _(t):
    return PO.pair_sizes(PO.posed_boxes(t.triangles, PO.role_poses(resolved(t))))


_EIGHT = "(SELECT mesh_id, " + ", ".join(
    f"unnest([{', '.join(('max' if (k >> i) & 1 else 'min') + a for k in range(8))}]) AS v{a}" for i, a in enumerate("xyz")
) + " FROM mesh_bounds)"


@query("a12_corner_box", f"""
    SELECT sample_id, role, {", ".join(f"{r6(f'max{a} - min{a}')} AS size{a}" for a in "xyz")} FROM ({_moved_box(_EIGHT, "v").replace("least(", "(").replace("greatest(", "(")})""")
def _(t):
    boxes = PO.corner_boxes(M.bounds(t.triangles), PO.role_poses(resolved(t)))
    return boxes.select("sample_id", "role", *[T.fixed(F.col(f"size{a}")).alias(f"size{a}") for a in "xyz"])


_NEAREST_STEPS = """
    d AS (SELECT *, (bx-ax)*(x-ax)+(by_-ay)*(y-ay)+(bz-az)*(z-az) AS d1, (cx-ax)*(x-ax)+(cy-ay)*(y-ay)+(cz-az)*(z-az) AS d2,
        (bx-ax)*(x-bx)+(by_-ay)*(y-by_)+(bz-az)*(z-bz) AS d3, (cx-ax)*(x-bx)+(cy-ay)*(y-by_)+(cz-az)*(z-bz) AS d4,
        (bx-ax)*(x-cx)+(by_-ay)*(y-cy)+(bz-az)*(z-cz) AS d5, (cx-ax)*(x-cx)+(cy-ay)*(y-cy)+(cz-az)*(z-cz) AS d6 FROM pairs),
    e AS (SELECT *, d3*d6-d5*d4 AS va, d5*d2-d1*d6 AS vb, d1*d4-d3*d2 AS vc FROM d),
    f AS (SELECT *, CASE WHEN d1<=0 AND d2<=0 THEN 0 WHEN d3>=0 AND d4<=d3 THEN 1 WHEN vc<=0 AND d1>=0 AND d3<=0 THEN d1/(d1-d3)
          WHEN d6>=0 AND d5<=d6 THEN 0 WHEN vb<=0 AND d2>=0 AND d6<=0 THEN 0
          WHEN va<=0 AND d4-d3>=0 AND d5-d6>=0 THEN 1-(d4-d3)/((d4-d3)+(d5-d6)) ELSE vb/(va+vb+vc) END AS bv,
        CASE WHEN d1<=0 AND d2<=0 THEN 0 WHEN d3>=0 AND d4<=d3 THEN 0 WHEN vc<=0 AND d1>=0 AND d3<=0 THEN 0
          WHEN d6>=0 AND d5<=d6 THEN 1 WHEN vb<=0 AND d2>=0 AND d6<=0 THEN d2/(d2-d6)
          WHEN va<=0 AND d4-d3>=0 AND d5-d6>=0 THEN (d4-d3)/((d4-d3)+(d5-d6)) ELSE vc/(va+vb+vc) END AS bw FROM e),
    w AS (SELECT *, ax+(bx-ax)*bv+(cx-ax)*bw AS wx, ay+(by_-ay)*bv+(cy-ay)*bw AS wy, az+(bz-az)*bv+(cz-az)*bw AS wz FROM f),
    near AS (SELECT *, sqrt((wx-x)*(wx-x)+(wy-y)*(wy-y)+(wz-z)*(wz-z)) AS dist FROM w)""".replace("by_", '"by"')


def nearest_sql(pairs: str) -> str:
    """CTEs that end in ``near(..., dist, wx, wy, wz)`` for point-triangle rows."""
    return f"pairs AS ({pairs}), {_NEAREST_STEPS}"


_TRI = ", ".join(f't."{c}"' for c in M.COORDS)


@query("g8_closest_point", f"""
    WITH {nearest_sql(f"SELECT point_id, x, y, z, t.tri_id, {_TRI} FROM points JOIN triangles t ON t.tri_id // 7 = point_id")}
    SELECT point_id, tri_id, {r6('dist')} AS dist, {r6('wx')} AS wx, {r6('wy')} AS wy, {r6('wz')} AS wz FROM near""")
def _(t):
    own = t.triangles.withColumn("point_id", F.floor(F.col("tri_id") / 7)).drop("mesh_id")
    rows = t.points.join(own, "point_id")
    rows = G.with_closest(rows, G.vec(""), *M.corners())
    witness = G.blend(*M.corners(), F.col("_v"), F.col("_w"))
    return rows.select(
        "point_id", "tri_id", T.fixed(G.norm(G.sub(witness, G.vec("")))).alias("dist"),
        *[T.fixed(c).alias(f"w{a}") for c, a in zip(witness, "xyz")],
    )


_LEN = "sqrt(embedding[1]::DOUBLE*embedding[1]::DOUBLE + embedding[2]::DOUBLE*embedding[2]::DOUBLE + embedding[3]::DOUBLE*embedding[3]::DOUBLE)"


@query("g10_unit_and_change", f"""
    SELECT vec_id, {", ".join(f"{r6(f'embedding[{i}]::DOUBLE / {_LEN}')} AS u{a}" for i, a in ((1, "x"), (2, "y"), (3, "z")))},
      vec_id % 2 = 0 AS changed FROM embeddings""")
def _(t):
    e = t.embeddings.select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    v = tuple(F.get("e", i) for i in range(3))
    nudge = F.when(F.col("vec_id") % 2 == 0, 1e-5).otherwise(1e-8)
    return e.select("vec_id", *[T.fixed(c).alias(f"u{a}") for c, a in zip(G.unit(v), "xyz")],
                    P.changed_pose(F.col("e"), F.transform("e", lambda x: x + nudge)).alias("changed"))


_U1, _U2 = uniform("b1", "tri_id"), uniform("b2", "tri_id")
_BARY = [f"{'a' + a} * (1 - sqrt({_U1})) + {'b' + a if a != 'y' else chr(34) + 'by' + chr(34)} * ({_U2} * sqrt({_U1})) + {'c' + a} * (sqrt({_U1}) - {_U2} * sqrt({_U1}))" for a in "xyz"]


@query("g11_barycentric_point", f"SELECT tri_id, {', '.join(f'{r6(e)} AS {a}' for e, a in zip(_BARY, 'xyz'))} FROM triangles")
def _(t):
    key = F.col("tri_id")
    point = M.barycentric_point(T.md5_uniform("b1", key), T.md5_uniform("b2", key))
    return t.triangles.select("tri_id", *[T.fixed(c).alias(a) for c, a in zip(point, "xyz")])


_B_ROT = "SELECT sample_id, roll AS pitch, pitch AS yaw, yaw AS roll FROM poses"


@query("g15_relative_pose", f"""
    WITH o AS (SELECT a.*, b.qx AS ox, b.qy AS oy, b.qz AS oz, b.qw AS ow, midx, midy, midz FROM turns a
      JOIN ({SQL_VIEWS['rotations'].replace('FROM poses', f'FROM ({_B_ROT})')}) b USING (sample_id) JOIN mesh_bounds USING (mesh_id))
    SELECT sample_id, {", ".join(f"{r6(e)} AS r{a}" for e, a in zip(turned([f'{c} - mid{a}' for c, a in zip(CTR, 'xyz')], back=True), 'xyz'))},
      {", ".join(f"{r6(f'{c} - mid{a}')} AS e{a}" for c, a in zip(CTR, 'xyz'))},
      {r6('qw*ox - qx*ow - qy*oz + qz*oy')} AS rqx, {r6('qw*oy - qy*ow - qz*ox + qx*oz')} AS rqy,
      {r6('qw*oz - qz*ow - qx*oy + qy*ox')} AS rqz, {r6('qw*ow + qx*ox + qy*oy + qz*oz')} AS rqw FROM o""")
def _(t):
    mids = M.bounds(t.triangles).select("mesh_id", "midx", "midy", "midz")
    rows = PO.with_rotation(t.poses).join(mids, "mesh_id")
    other = G.from_euler(F.col("roll"), F.col("pitch"), F.col("yaw"))
    center, position = G.vec("mid"), G.vec("c")
    rel, rotation = PO.relative(center, PO.quaternion(), position, other)
    return rows.select(
        "sample_id", *[T.fixed(c).alias(f"r{a}") for c, a in zip(rel, "xyz")],
        *[T.fixed(c).alias(f"e{a}") for c, a in zip(G.sub(position, center), "xyz")],
        *[T.fixed(c).alias(f"rq{a}") for c, a in zip(rotation, "xyzw")],
    )


# ---- measures over meshes ---------------------------------------------------------------

_BOUND_COLUMNS = [f"{n}{a}" for n in ("min", "max", "mid", "size") for a in "xyz"]


@query("a9_mesh_bounds", f"""
    SELECT mesh_id, {", ".join(f"{r6(c)} AS {c}" for c in _BOUND_COLUMNS)}, NOT greatest(sizex, sizey, sizez) > 0 AS degenerate FROM mesh_bounds
    UNION ALL SELECT -mesh_id - 1, {", ".join(r6(c) for c in _BOUND_COLUMNS)}, NOT greatest(sizex, sizey, sizez) > 0 FROM box_bounds""")
def _(t):
    boxes = M.bounds(t.boxes).withColumn("mesh_id", -F.col("mesh_id") - 1)
    return M.bounds(t.triangles).unionByName(boxes).select(
        "mesh_id", *[T.fixed(F.col(c)).alias(c) for c in _BOUND_COLUMNS], "degenerate")


_CROSS = {
    "x": '("by"-ay)*(cz-az)-(bz-az)*(cy-ay)', "y": "(bz-az)*(cx-ax)-(bx-ax)*(cz-az)", "z": '(bx-ax)*(cy-ay)-("by"-ay)*(cx-ax)'
}
_AREA = "sqrt(" + " + ".join(f"({e})*({e})" for e in _CROSS.values()) + ") / 2"
SQL_VIEWS["sized"] = f"SELECT *, {_AREA} AS area FROM triangles"


@query("a13_surface_area", f"""
    SELECT mesh_id, {r6('sum(area)')} AS area, count(*) AS triangles FROM sized GROUP BY mesh_id
    UNION ALL SELECT -mesh_id - 1, {r6(f'sum({_AREA})')}, count(*) FROM boxes GROUP BY mesh_id""")
def _(t):
    boxes = M.surface_area(t.boxes).withColumn("mesh_id", -F.col("mesh_id") - 1)
    return M.surface_area(t.triangles).unionByName(boxes).withColumn("area", T.fixed(F.col("area")))


SQL_VIEWS["bodies"] = """
    SELECT p.*, x - mx AS dx, y - my AS dy, z - mz AS dz, mx, my, mz FROM points p
    JOIN (SELECT mesh_id, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM points GROUP BY mesh_id) USING (mesh_id)"""
_MOMENTS = {
    "cx": "any_value(mx)", "cy": "any_value(my)", "cz": "any_value(mz)", "radius": "max(sqrt(dx*dx+dy*dy+dz*dz))",
    "ixx": "avg(dy*dy+dz*dz)", "iyy": "avg(dx*dx+dz*dz)", "izz": "avg(dx*dx+dy*dy)", "ixy": "avg(-dx*dy)", "ixz": "avg(-dx*dz)", "iyz": "avg(-dy*dz)",
}


@query("a14_body_moments", f"SELECT mesh_id, {', '.join(f'{r6(e)} AS {n}' for n, e in _MOMENTS.items())} FROM bodies GROUP BY mesh_id")
def _(t):
    return M.moments(t.points, "mesh_id").select("mesh_id", *[T.fixed(F.col(n)).alias(n) for n in _MOMENTS])


_NORMAL = "sqrt(nx*nx + ny*ny + nz*nz)"


@query("a15_vertex_normals", f"""
    WITH v AS (SELECT mesh_id, {_CROSS['x']} AS tx, {_CROSS['y']} AS ty, {_CROSS['z']} AS tz, unnest([ax, bx, cx]) AS vx, unnest([ay, "by", cy]) AS vy, unnest([az, bz, cz]) AS vz FROM boxes),
      s AS (SELECT mesh_id, vx, vy, vz, sum(tx) AS nx, sum(ty) AS ny, sum(tz) AS nz FROM v GROUP BY ALL)
    SELECT mesh_id, vx, vy, vz, {", ".join(f"{r6(f'n{a} / CASE WHEN {_NORMAL} = 0 THEN 1 ELSE {_NORMAL} END')} AS n{a}" for a in "xyz")} FROM s""")
def _(t):
    return M.vertex_normals(t.boxes).select("mesh_id", "vx", "vy", "vz", *[T.fixed(F.col(f"n{a}")).alias(f"n{a}") for a in "xyz"])


DRAWS = 2_000  # per mesh
_KEY = "mesh_id || '/' || draw_id"
SQL_VIEWS["draws"] = f"""
    SELECT mesh_id, draw_id, {uniform('surfaceu', _KEY)} AS u, {uniform('surfaceu1', _KEY)} AS u1, {uniform('surfaceu2', _KEY)} AS u2
    FROM (SELECT DISTINCT mesh_id FROM triangles), range({DRAWS}) r(draw_id)"""
SQL_VIEWS["cumulative"] = """
    SELECT *, sum(area) OVER (PARTITION BY mesh_id ORDER BY tri_id) AS upto, sum(area) OVER (PARTITION BY mesh_id) AS total FROM sized"""
SQL_VIEWS["picks"] = """
    SELECT d.mesh_id, draw_id, tri_id, u1, u2, ax, ay, az, bx, "by", bz, cx, cy, cz, u * total AS pick FROM draws d
    JOIN cumulative c ON c.mesh_id = d.mesh_id AND u * total > upto - area AND u * total <= upto"""


@query("w8_area_picks", f"SELECT mesh_id, draw_id, tri_id, {r6('pick')} AS pick FROM picks")
def _(t):
    draws = M.surface_draws(t.triangles.select("mesh_id").distinct(), DRAWS, "surface")
    return M.area_picks(t.triangles, draws).withColumn("pick", T.fixed(F.col("pick")))


_SPOT = [f'a{a} * (1 - sqrt(u1)) + "b{a}" * (u2 * sqrt(u1)) + c{a} * (sqrt(u1) - u2 * sqrt(u1))' for a in "xyz"]


@query("v8_surface_points", f"SELECT mesh_id, draw_id, {', '.join(f'{r6(e)} AS {a}' for e, a in zip(_SPOT, 'xyz'))} FROM picks")
def _(t):
    points = M.surface_points(t.triangles, DRAWS)
    return points.select("mesh_id", "draw_id", *[T.fixed(F.col(a)).alias(a) for a in "xyz"])


@query("a23_embed_depth", """
    SELECT mesh_id, round(max(e) - min(e), 6) AS extent, round(-least(least(greatest(max(mesh_id) * 0.08::DOUBLE, 0.02), 0.5) * (max(e) - min(e)), 0.45 * (max(e) - min(e))), 6) AS depth
    FROM (SELECT mesh_id, x * 0.6 + y * 0 + z * 0.8::DOUBLE AS e FROM points) GROUP BY mesh_id""")
def _(t):
    from plinth.operators import proximity as X

    found = X.embed_depth(t.points, G.literal((0.6, 0.0, 0.8)), F.col("mesh_id") * 0.08)
    return found.select("mesh_id", T.fixed(F.col("extent")).alias("extent"), T.fixed(F.col("depth")).alias("depth"))
