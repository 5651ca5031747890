"""Measures over triangle tables ``(mesh_id, tri_id, ax..cz)``: bounds, areas, normals, samples."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions import text as T
from plinth.functions import vectors as G
from plinth.operators.ordering import Ordered
from plinth.operators.skew import salted_join
from plinth.runtime import cut

COORDS = [v + axis for v in "abc" for axis in "xyz"]


def _box_signs() -> list[tuple[float, ...]]:
    """Twelve outward triangles of a unit box as nine signed half sizes each."""
    out = []
    for axis in range(3):
        for side in (-0.5, 0.5):
            square = [(-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5)]
            quad = []
            for u, v in square if side > 0 else reversed(square):
                corner = [0.0, 0.0, 0.0]
                corner[axis], corner[(axis + 1) % 3], corner[(axis + 2) % 3] = side, u, v
                quad.append(tuple(corner))
            out += [quad[0] + quad[1] + quad[2], quad[0] + quad[2] + quad[3]]
    return out


BOX_SIGNS = _box_signs()


def box_triangles(sizes: DataFrame) -> DataFrame:
    """Closed boxes centred at the origin from ``(mesh_id, sx, sy, sz)``."""
    faces = F.array(*[F.struct(F.lit(k).alias("tri_id"), *[F.lit(s).alias(c) for c, s in zip(COORDS, signs)])
                      for k, signs in enumerate(BOX_SIGNS)])
    size = [F.col(n) for n in ("sx", "sy", "sz")]
    return sizes.withColumn("f", F.explode(faces)).select(
        "mesh_id", F.col("f.tri_id").cast("long").alias("tri_id"),
        *[(F.col(f"f.{c}") * size[i % 3]).alias(c) for i, c in enumerate(COORDS)],
    )


def exact(df: DataFrame, columns: list[str]) -> DataFrame:
    """Coordinates with nulls turned into NaN, which no distance test accepts.

    Non-nullable inputs halve the generated code of the long formulas built on them.
    """
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(float("nan"))) for c in columns})


def corners() -> tuple[G.Vec, G.Vec, G.Vec]:
    return G.vec("a"), G.vec("b"), G.vec("c")


def area() -> Column:
    return G.norm(G.triangle_cross(*corners())) / 2


def bounds(triangles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Box, centre, size and longest side per mesh; only six partial extremes are shuffled."""
    by = by or ["mesh_id"]
    ends = [
        agg(pick(*[F.col(v + axis) for v in "abc"])).alias(name + axis)
        for axis in "xyz"
        for name, pick, agg in (("min", F.least, F.min), ("max", F.greatest, F.max))
    ]
    boxed = triangles.groupBy(*by).agg(*ends)
    sized = boxed.select(
        "*",
        *[((F.col(f"min{a}") + F.col(f"max{a}")) / 2).alias(f"mid{a}") for a in "xyz"],
        *[(F.col(f"max{a}") - F.col(f"min{a}")).alias(f"size{a}") for a in "xyz"],
    )
    longest = F.greatest("sizex", "sizey", "sizez")
    return sized.withColumn("longest", longest).withColumn("degenerate", ~(longest > 0))


def surface_area(triangles: DataFrame) -> DataFrame:
    return triangles.groupBy("mesh_id").agg(F.sum(area()).alias("area"), F.count(F.lit(1)).alias("triangles"))


def moments(points: DataFrame, by: str | list[str]) -> DataFrame:
    """Centroid, radius and inertia tensor entries of a sample shell.

    The second pass joins back one row per body; AQE broadcasts it or splits a hot body.
    """
    by = [by] if isinstance(by, str) else by
    centre = points.groupBy(*by).agg(*[F.avg(a).alias(f"m{a}") for a in "xyz"])
    d = {a: F.col(a) - F.col(f"m{a}") for a in "xyz"}
    x, y, z = d["x"], d["y"], d["z"]
    return points.join(centre, by).groupBy(*by).agg(
        *[F.first(f"m{a}").alias(f"c{a}") for a in "xyz"],
        F.max(F.sqrt(x * x + y * y + z * z)).alias("radius"),
        F.avg(y * y + z * z).alias("ixx"), F.avg(x * x + z * z).alias("iyy"), F.avg(x * x + y * y).alias("izz"),
        F.avg(-x * y).alias("ixy"), F.avg(-x * z).alias("ixz"), F.avg(-y * z).alias("iyz"),
    )


def vertex_normals(triangles: DataFrame) -> DataFrame:
    """Area-weighted unit normal per distinct vertex position of a mesh (zero stays zero)."""
    cross = G.triangle_cross(*corners())
    corner = F.explode(F.array(*[F.struct(*[F.col(v + a).alias(f"v{a}") for a in "xyz"]) for v in "abc"]))
    sums = (
        triangles.select("mesh_id", *[c.alias(f"n{a}") for c, a in zip(cross, "xyz")], corner.alias("v"))
        .groupBy("mesh_id", F.col("v.vx").alias("vx"), F.col("v.vy").alias("vy"), F.col("v.vz").alias("vz"))
        .agg(*[F.sum(f"n{a}").alias(f"n{a}") for a in "xyz"])
    )
    length = G.norm(G.vec("n"))
    length = F.when(length == 0, F.lit(1.0)).otherwise(length)
    return sums.select("mesh_id", "vx", "vy", "vz", *[(F.col(f"n{a}") / length).alias(f"n{a}") for a in "xyz"])


def transformed(joined: DataFrame, position: G.Vec, rotation: G.Quat, scale: G.Vec) -> DataFrame:
    """Triangles with a pose applied to each corner; other columns are kept."""
    moved = {}
    for corner in "abc":
        for axis, value in zip("xyz", G.apply_pose(position, rotation, scale, G.vec(corner))):
            moved[corner + axis] = value
    return joined.withColumns(moved)


def pose_meshes(parts: DataFrame, poses: DataFrame, tie: str = "tri_id") -> DataFrame:
    """Triangles (or other parts) of each pose's mesh: a mesh shared by many poses is split by its counts."""
    return salted_join(parts, poses, ["mesh_id"], tie, "sample_id")


def _fan() -> tuple[list[tuple[int, ...]], list[tuple[int, ...]]]:
    """The 26 directions to a cube's corners, edges and faces, and the triangles they span on its surface."""
    ways = [w for w in itertools.product((-1, 0, 1), repeat=3) if any(w)]
    faces = []
    for axis in range(3):
        for side in (-1, 1):
            def at(p: int, q: int) -> int:
                way = [0, 0, 0]
                way[axis], way[(axis + 1) % 3], way[(axis + 2) % 3] = side, p, q
                return ways.index(tuple(way))

            for p, q in itertools.product((-1, 0), repeat=2):
                faces += [(at(p, q), at(p + 1, q), at(p + 1, q + 1)), (at(p, q), at(p + 1, q + 1), at(p, q + 1))]
    return ways, faces


FAN, FAN_FACES = _fan()


def outer_vertices(triangles: DataFrame) -> DataFrame:
    """Distinct vertices ``mesh_id, vx, vy, vz`` of each mesh without those that no direction can make extreme.

    The farthest vertices along a fan of directions span tetrahedra around a point among them. What lies within one of
    these is a mixture of other points of the mesh, so no turn makes it an end of the box; all else stays. Boxes of turned
    meshes are the same with these vertices as with all of them. Vertices with a null or NaN coordinate are left out.
    """
    corner = F.explode(F.array(*[F.struct(*[F.col(v + a).alias(f"v{a}") for a in "xyz"]) for v in "abc"]))
    every = triangles.select("mesh_id", corner.alias("v")).select("mesh_id", "v.*")
    known = every.where(" AND ".join(f"v{a} IS NOT NULL AND NOT isnan(v{a})" for a in "xyz"))
    reach = lambda w: sum((F.col(f"v{a}") * k for a, k in zip("xyz", w) if k), F.lit(0.0))
    ends = known.groupBy("mesh_id").agg(F.array(*[F.max_by(F.struct("vx", "vy", "vz"), reach(w)) for w in FAN]).alias("e"))
    axes = [FAN.index(tuple(s if b == a else 0 for b in range(3))) for a in range(3) for s in (-1, 1)]
    middle = ends.select("mesh_id", "e", *[(sum(F.col("e")[i][f"v{a}"] for i in axes) / len(axes)).alias(f"m{a}") for a in "xyz"]).withColumn(
        "_size", F.greatest(*[F.col("e")[axes[2 * n + 1]][f"v{a}"] - F.col("e")[axes[2 * n]][f"v{a}"] for n, a in enumerate("xyz")]))
    centre = G.vec("m")

    def inverse(face: Column) -> Column:
        """Rows of the inverse of a tetrahedron's edges from the middle; null for a flat one."""
        p, q, r = (G.sub(tuple(F.get("e", face[k])[f"v{a}"] for a in "xyz"), centre) for k in "ijk")
        rows = [G.cross(q, r), G.cross(r, p), G.cross(p, q)]
        det = G.dot(p, rows[0])
        whole = F.struct(*[(c / det).alias(f"r{n}{a}") for n, row in enumerate(rows) for c, a in zip(row, "xyz")])
        return F.when(F.abs(det) > 1e-9 * F.col("_size") * F.col("_size") * F.col("_size"), whole)

    faces = F.array(*[F.struct(*[F.lit(i).alias(k) for k, i in zip("ijk", face)]) for face in FAN_FACES])
    solids = cut(middle.select("mesh_id", *[f"m{a}" for a in "xyz"], F.transform(faces, inverse).alias("solids")))

    def within(solid: Column) -> Column:
        shares = [sum(solid[f"r{n}{a}"] * (F.col(f"v{a}") - F.col(f"m{a}")) for a in "xyz") for n in range(3)]
        return F.coalesce((shares[0] >= 0) & (shares[1] >= 0) & (shares[2] >= 0) & (shares[0] + shares[1] + shares[2] < 1 - 1e-9), F.lit(False))

    # Most vertices lie in the tetrahedron of their own direction; the others are tried against all, once each is distinct.
    own = F.array(F.get("solids", _face_of(G.sub(G.vec("v"), centre))))  # as an array of one, so that it is evaluated once
    # They join again rather than carry the tetrahedra, which are fifty times as large, through a grouping.
    left = known.join(solids, "mesh_id").where(~F.exists(own, within)).select("mesh_id", "vx", "vy", "vz").distinct()
    return left.join(solids, "mesh_id").where(~F.exists("solids", within)).select("mesh_id", "vx", "vy", "vz")


def _face_of(way: G.Vec) -> Column:
    """Index in ``FAN_FACES`` of the triangle that a direction passes."""
    size = [F.abs(w) for w in way]
    longest = F.greatest(*size)
    out = F.lit(0)
    for axis in reversed(range(3)):
        p, q = (way[(axis + k) % 3] / longest for k in (1, 2))
        low = lambda c: F.when(c < 0, 0).otherwise(1)
        above = F.when(p - F.when(p < 0, -1).otherwise(0) >= q - F.when(q < 0, -1).otherwise(0), 0).otherwise(1)
        face = ((F.lit(2 * axis) + low(way[axis])) * 4 + low(p) * 2 + low(q)) * 2 + above
        out = F.when(size[axis] == longest, face).otherwise(out)
    return out


def box_corners(boxes: DataFrame) -> DataFrame:
    """Eight corners of each row's box as vertex rows ``vx, vy, vz`` (cheap transformed bound)."""
    pick = lambda axis, high: F.col(("max" if high else "min") + axis).alias(f"v{axis}")
    eight = [F.struct(*[pick(a, (k >> i) & 1) for i, a in enumerate("xyz")]) for k in range(8)]
    return boxes.withColumn("v", F.explode(F.array(*eight))).select("*", "v.*").drop("v")


def cumulative_area(triangles: DataFrame) -> DataFrame:
    """Running area per mesh in ``tri_id`` order, with the mesh total (hot meshes stay split)."""
    sized = triangles.withColumn("area", area())
    summed = Ordered(sized, ["tri_id"], by=["mesh_id"]).running_sum("area", "upto").done()
    totals = sized.groupBy("mesh_id").agg(F.sum("area").alias("total"))
    return summed.join(totals, "mesh_id")


def area_picks(triangles: DataFrame, draws: DataFrame) -> DataFrame:
    """The triangle each draw ``(mesh_id, draw_id, u)`` lands in, by inverse cumulative area.

    Triangles start at their preceding area and draws sit at ``u * total``; merging both by
    position turns the search into "newest triangle before me", which ``Ordered`` splits into
    ranges. The merged table is written once so that every branch sees the same sums.
    """
    summed = cumulative_area(triangles)
    starts = summed.select(
        "mesh_id", (F.col("upto") - F.col("area")).alias("pos"), F.lit(0).alias("is_draw"),
        F.col("tri_id").alias("item"), F.col("tri_id").alias("tri"),
    )
    totals = triangles.groupBy("mesh_id").agg(F.sum(area()).alias("total"))
    aims = draws.join(totals, "mesh_id").select(
        "mesh_id", (F.col("u") * F.col("total")).alias("pos"), F.lit(1).alias("is_draw"),
        F.col("draw_id").alias("item"), F.lit(None).cast("long").alias("tri"),
    )
    merged = cut(starts.unionByName(aims))
    found = Ordered(merged, ["pos", "is_draw", "item"], by=["mesh_id"]).last_before("tri", "tri_id").done()
    return found.where("is_draw = 1").select("mesh_id", F.col("item").alias("draw_id"), "tri_id", F.col("pos").alias("pick"))


def surface_draws(meshes: DataFrame, per_mesh: int, seed: str) -> DataFrame:
    """Seeded uniform draws for each mesh id: ``(mesh_id, draw_id, u, u1, u2)``."""
    key = F.concat_ws("/", "mesh_id", "draw_id")
    spread = meshes.select("mesh_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(per_mesh - 1).cast("long"))).alias("draw_id"))
    return spread.select("*", *[T.md5_uniform(f"{seed}{n}", key).alias(n) for n in ("u", "u1", "u2")])


def barycentric_point(u1: Column, u2: Column) -> G.Vec:
    """Uniform point of triangle abc from two uniform draws."""
    root = F.sqrt(u1)
    u = 1 - root
    v = u2 * root
    a, b, c = corners()
    return G.add(G.add(G.scaled(a, u), G.scaled(b, v)), G.scaled(c, 1 - u - v))


def surface_points(triangles: DataFrame, per_mesh: int, seed: str = "surface") -> DataFrame:
    """Deterministic area-weighted surface samples of every mesh."""
    draws = surface_draws(triangles.select("mesh_id").distinct(), per_mesh, seed)
    picks = area_picks(triangles, draws).join(draws.select("mesh_id", "draw_id", "u1", "u2"), ["mesh_id", "draw_id"])
    point = barycentric_point(F.col("u1"), F.col("u2"))
    return picks.join(triangles, ["mesh_id", "tri_id"]).select(
        "mesh_id", "draw_id", "tri_id", *[c.alias(a) for c, a in zip(point, "xyz")]
    )
