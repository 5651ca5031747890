"""Nearest-surface joins, field sampling and contact measurements."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.functions import vectors as G
from plinth.operators import meshes as M
from plinth.operators.parts import Parts, chunks, ids, stored, with_nulls
from plinth.operators.surfaces import Surface
from plinth.runtime import cut

FIRST_RING = 2.0       # cells of the anchor's grid that every point looks at
SURE = 1 + 1e-9        # a reach counts as searched only by less than rounding could move a cell
GAP_CELLS, BAND_CELLS = 6.0, 5.0  # how far gaps and directional gaps are read off triangles
BRICK = 8              # cells a side of a brick of the field
SLIDE, SLIDE_SHARE = 0.25, 1.5    # horizontal travel of the support that a placement may show, and per radius
TOUCH = 0.001          # closer than this the witness point offers no direction
BLOCKING = 0.8         # share of a touched triangle's normal that must oppose the motion
ROTATION_CAP = 60.0    # degrees
EMBED_LEAST, EMBED_MOST, EMBED_SHARE = 0.02, 0.5, 0.45


def rings(cells: float, first: float = FIRST_RING) -> list[float]:
    """Reaches of the search in cells: doubled until the last one covers ``cells``, a hair more so that it is exact."""
    out = [first]
    while out[-1] < cells:
        out.append(2 * out[-1])
    return [*out[:-1], cells * SURE]


def _searched(rows: DataFrame, triangles: DataFrame, reach: Column, limit: Column, keys: Sequence[str]) -> DataFrame:
    """``rows`` with their nearest triangle no farther than ``limit``; that is ``reach``, the same for all rows of a mesh, or null.

    Triangles are written once, by mesh; rows are dealt in ranges of meshes, and a task reads the triangles of those it
    meets. So no pairs are shuffled, and a task holds a block of triangles and a chunk of rows at a time.
    """
    path = stored(triangles.select("mesh_id", F.col("tri_id").cast("long").alias("tri_id"), *[F.col(c).cast("double").alias(c) for c in M.COORDS]), "tri_id")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = rows.columns
    dealt = rows.select("*", reach.alias("_reach"), limit.alias("_limit")).repartitionByRange(n, "mesh_id", *keys)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reaches = {}
        parts = Parts(path, lambda mesh, t: Surface(
            ids(t.column("tri_id")), np.stack([t.column(c).to_numpy() for c in M.COORDS], axis=1), reaches[mesh]))
        for table in chunks(batches, ["mesh_id"]):
            p = np.stack([table.column(a).to_numpy() for a in "xyz"], axis=1).astype(float)
            far = table.column("_limit").to_numpy().astype(float)
            dist, tri, w = np.full(len(p), np.nan), np.full(len(p), -1), np.full((3, len(p)), np.nan)
            mesh = table.column("mesh_id")[0].as_py()
            if mesh is not None and not np.isnan(far).all():
                reaches[mesh] = float(np.nanmax(table.column("_reach").to_numpy()))
                for surface in parts.of(mesh):
                    surface.improve(p, far, tri, dist, w)
            none = np.isnan(dist)
            out = {**{c: table.column(c) for c in held}, "dist": pa.array(dist, mask=none), "tri_id": with_nulls(tri, none),
                   **{f"w{a}": pa.array(c, mask=none) for a, c in zip("xyz", w)}}
            yield from pa.table(out).to_batches()

    found = [T.StructField("dist", T.DoubleType()), T.StructField("tri_id", T.LongType()), *[T.StructField(f"w{a}", T.DoubleType()) for a in "xyz"]]
    return dealt.mapInArrow(search, T.StructType([*rows.schema, *found]))


def nearest_surface(points: DataFrame, triangles: DataFrame, grids: DataFrame, cells: float, keys: Sequence[str] = ("point_id",)) -> DataFrame:
    """Nearest triangle of its mesh within ``cells`` grid cells of each point, with its witness point.

    ``points(mesh_id, keys, x, y, z)`` are in the mesh's frame, ``grids(mesh_id, cell)`` give the length of a cell per
    mesh. Points without a triangle in reach, with null coordinates or of a mesh without a grid keep nulls. Ties go to
    the smaller ``tri_id``. Points are read twice, the first time to deal them.
    """
    wanted = points.select("mesh_id", *keys, "x", "y", "z")
    step = grids.select("mesh_id", F.col("cell").alias("_h"))
    reach = F.col("_h") * cells
    return _searched(wanted.join(step, "mesh_id", "left"), triangles, reach, reach, keys).drop("_h")


# ---- field sampling ---------------------------------------------------------------------

def field_bricks(phi: DataFrame, headers: DataFrame) -> DataFrame:
    """The field as bricks: values of ``BRICK`` cells a side, one layer before and two behind, so that a sample and its
    neighbours half a cell away read one row.

    That is 2.6 rows per cell at most, while one row per sample cell would take eight. Values lie in the order x, y, z.
    """
    sized = phi.join(headers.select("mesh_id", "nx", "ny", "nz"), "mesh_id")
    for a in "xyz":
        last = F.greatest(F.lit(0), F.floor((F.col(f"n{a}") - 2) / BRICK))
        first = F.greatest(F.lit(0), F.ceil((F.col(a) - BRICK - 1) / BRICK))
        sized = sized.withColumn(f"b{a}", F.explode(F.sequence(first, F.least(F.floor((F.col(a) + 1) / BRICK), last)).cast("array<int>")))
    return sized.groupBy("mesh_id", "bx", "by", "bz").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("x", "y", "z", "phi"))), lambda v: v["phi"]).alias("values")
    )


def _met(points: DataFrame, bricks: DataFrame, headers: DataFrame) -> DataFrame:
    """Points with their grid and the brick around them, from which all samples up to half a cell away can be read."""
    joined = points.join(headers.select("mesh_id", "cell", "nx", "ny", "nz", "gx", "gy", "gz"), "mesh_id")
    home = {f"b{a}": F.floor(_inside(a, F.col(a))[1] / BRICK).cast("int") for a in "xyz"}
    return joined.withColumns(home).join(bricks, ["mesh_id", "bx", "by", "bz"])


def _inside(a: str, at: Column) -> tuple[Column, Column]:
    """A coordinate in cells, as it is and held inside the grid."""
    raw = (at - F.col(f"g{a}")) / F.col("cell") - 0.5
    return raw, F.greatest(F.lit(0.0), F.least(raw, F.col(f"n{a}") - 1.001))


def _sampled(met: DataFrame, out: str, moved: dict[str, Column] | None = None) -> DataFrame:
    """``met`` with the trilinear sample at ``x, y, z`` or at ``moved``; beyond the grid a safe lower bound."""
    at = {a: _inside(a, (moved or {}).get(a, F.col(a))) for a in "xyz"}
    outside = F.sqrt(sum(((raw - u) * F.col("cell")) ** 2 for raw, u in at.values()))
    first = {a: F.greatest(F.lit(0), F.col(f"b{a}") * BRICK - 1) for a in "xyz"}
    held = met.withColumns({**{f"_u{a}": u for a, (_, u) in at.items()}, "_outside": outside})
    low = {a: (F.floor(f"_u{a}") - first[a]).cast("int") for a in "xyz"}
    side = {a: F.least(F.col(f"n{a}"), F.col(f"b{a}") * BRICK + BRICK + 2) - first[a] for a in "yz"}
    frac = {a: F.col(f"_u{a}") - F.floor(f"_u{a}") for a in "xyz"}

    def weight(a: str, bit: int) -> Column:
        return frac[a] if bit else 1 - frac[a]

    value = F.lit(0.0)
    for i in (0, 1):
        for j in (0, 1):
            for k in (0, 1):
                place = ((low["x"] + i) * side["y"] + low["y"] + j) * side["z"] + low["z"] + k
                value = value + F.get("values", place) * weight("x", i) * weight("y", j) * weight("z", k)
    inside = held.withColumn("_value", value)
    result = F.when(
        F.col("_outside") > 0, F.greatest(F.col("_outside"), F.col("_value") - F.col("_outside"))
    ).otherwise(F.col("_value"))
    return inside.withColumn(out, result)


PROBES = [(0.0, 0.0, 0.0)] + [tuple(s * (i == n) for i in range(3)) for n in range(3) for s in (0.5, -0.5)]


def _gradients(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Samples at the probes of a point, which lie behind one another, as one row with value and unit gradient."""
    rest, n = None, len(PROBES)
    for batch in batches:
        rows = batch if rest is None else pa.concat_batches([rest, batch])
        whole = rows.num_rows // n * n
        rest = rows.slice(whole)
        value = rows.column("phi").slice(0, whole).to_numpy(zero_copy_only=False).reshape(-1, n)
        g = [value[:, 2 * a + 1] - value[:, 2 * a + 2] for a in range(3)]
        length = np.sqrt(g[0] * g[0] + g[1] * g[1] + g[2] * g[2])
        steep = length > 1e-12
        unit = [np.where(steep, c / np.where(steep, length, 1.0), flat) for c, flat in zip(g, (0.0, 1.0, 0.0))]
        first = rows.take(pa.array(np.arange(0, whole, n)))
        yield pa.RecordBatch.from_arrays([*first.columns, *map(pa.array, unit)], names=[*first.schema.names, "gradx", "grady", "gradz"])


def field_gradient(points: DataFrame, bricks: DataFrame, headers: DataFrame) -> DataFrame:
    """``points`` with the field value and its unit central-difference gradient (+Y when flat).

    A point's seven probes read one brick and stay in their task, where they fold again, so nothing is shuffled.
    """
    probes = F.inline(F.array(*[F.struct(*[F.lit(s).alias(f"_t{a}") for s, a in zip(probe, "xyz")]) for probe in PROBES]))
    probed = _met(points, bricks, headers).select("*", probes)
    moved = {a: F.col(a) + F.col(f"_t{a}") * F.col("cell") for a in "xyz"}
    sampled = _sampled(probed, "phi", moved).select(*points.columns, "phi")
    schema = T.StructType([*sampled.schema, *[T.StructField(f"grad{a}", T.DoubleType()) for a in "xyz"]])
    return sampled.mapInArrow(_gradients, schema)


def embed_points(points: DataFrame, nodes: DataFrame, headers: DataFrame, radius: int = 3) -> DataFrame:
    """Carry points along with displaced cell centres ``nodes(mesh_id, x, y, z, px, py, pz)``.

    The eight surrounding centres are weighted trilinearly over those that exist. A point with
    none around it takes the nearest node of its clamped cell within ``radius`` cells, scanning
    shells outward and, within a shell, y then z then x; with none at all it stays put.
    """
    keys = ["mesh_id", "point_id"]
    joined = points.select(*keys, "x", "y", "z").join(
        headers.select("mesh_id", "cell", "nx", "ny", "nz", "gx", "gy", "gz"), "mesh_id"
    )
    raw = {a: (F.col(a) - F.col(f"g{a}")) / F.col("cell") - 0.5 for a in "xyz"}
    based = joined.withColumns({f"u{a}": raw[a] for a in "xyz"})
    eight = F.explode(F.array(*[
        F.struct(*[F.lit((n >> i) & 1).alias(f"o{a}") for i, a in enumerate("xyz")]) for n in range(8)
    ]))
    spread = based.withColumn("o", eight).select(
        *keys,
        *[(F.floor(f"u{a}") + F.col(f"o.o{a}")).cast("int").alias(f"n{a}_") for a in "xyz"],
        *[F.when(F.col(f"o.o{a}") == 1, F.col(f"u{a}") - F.floor(f"u{a}"))
          .otherwise(1 - (F.col(f"u{a}") - F.floor(f"u{a}"))).alias(f"w{a}") for a in "xyz"],
    )
    weight = F.col("wx") * F.col("wy") * F.col("wz")
    at_node = nodes.select("mesh_id", *[F.col(a).alias(f"n{a}_") for a in "xyz"], "px", "py", "pz")
    met = spread.withColumn("w", weight).where("w > 0").join(at_node, ["mesh_id", "nx_", "ny_", "nz_"])
    carried = met.groupBy(*keys).agg(
        F.sum("w").alias("total"), *[F.sum(F.col("w") * F.col(f"p{a}")).alias(f"s{a}") for a in "xyz"]
    ).where("total > 1e-9")
    near = based.join(carried.select(*keys), keys, "left_anti")
    home = {a: F.least(F.col(f"n{a}") - 1, F.greatest(F.lit(0), F.floor(F.col(f"u{a}") + 0.5))).cast("int") for a in "xyz"}
    around = near.withColumns({f"h{a}": home[a] for a in "xyz"})
    for a in "xyz":
        around = around.withColumn(f"d{a}", F.explode(F.sequence(F.lit(-radius), F.lit(radius))))
    shell = F.greatest(F.abs("dx"), F.abs("dy"), F.abs("dz"))
    probes = around.select(
        *keys, shell.alias("shell"), "dx", "dy", "dz",
        *[F.least(F.col(f"n{a}") - 1, F.greatest(F.lit(0), F.col(f"h{a}") + F.col(f"d{a}"))).alias(f"n{a}_") for a in "xyz"],
    )
    rescued = probes.join(at_node, ["mesh_id", "nx_", "ny_", "nz_"]).groupBy(*keys).agg(
        F.min(F.struct("shell", "dy", "dz", "dx", "px", "py", "pz")).alias("b")
    )
    return (
        points.select(*keys, "x", "y", "z")
        .join(carried, keys, "left")
        .join(rescued, keys, "left")
        .select(
            *keys,
            *[F.coalesce(F.col(f"s{a}") / F.col("total"), F.col(f"b.p{a}"), F.col(a)).alias(f"e{a}") for a in "xyz"],
            F.when(F.col("total").isNotNull(), "lattice").when(F.col("b").isNotNull(), "nearest")
            .otherwise("unmoved").alias("via"),
        )
    )


# ---- contact measures -------------------------------------------------------------------
#
# A body is a set of points in the frame of its anchor ``mesh_id``; ``keys`` name its points, all but the last also the
# body. Many bodies share an anchor, whose triangles and field are built once.

def measured(points: DataFrame, triangles: DataFrame, bricks: DataFrame, headers: DataFrame, keys: Sequence[str] = ("point_id",),
             cells: float = GAP_CELLS) -> DataFrame:
    """Points with field value, gradient, the anchor's ``cell`` and their nearest surface within ``cells`` cells.

    Only points whose field value is below that reach look for triangles.
    """
    graded = cut(field_gradient(points, bricks, headers).join(headers.select("mesh_id", "cell"), "mesh_id"))
    reach = cells * F.col("cell")
    return _searched(graded, triangles, reach, F.when(F.col("phi") < reach, reach), keys)


def body_gap(rows: DataFrame, keys: Sequence[str] = ("point_id",)) -> DataFrame:
    """Gap per body from rows with ``phi`` and ``dist``: penetration if any, else exact distance, else the field's."""
    least = rows.groupBy("mesh_id", *keys[:-1]).agg(F.min("phi").alias("field_min"), F.min("dist").alias("exact"))
    gap = F.when(F.col("field_min") < 0, F.col("field_min")).otherwise(F.coalesce("exact", "field_min"))
    return least.withColumn("gap", gap)


def contact_table(before: DataFrame, after: DataFrame, triangles: DataFrame, bricks: DataFrame, headers: DataFrame,
                  turned: DataFrame, keys: Sequence[str] = ("sample_id", "point_id")) -> DataFrame:
    """Quality of each body's move from ``before`` to ``after`` (the same points): one row per body.

    All lengths are shares of the anchor's longest side. ``gap`` and ``gap_after`` are signed, ``depth`` is how far the
    body starts inside; ``drop`` and ``moved`` are travel of its centroid, ``drift`` is the horizontal travel of the point
    that was lowest; ``turned(body, rotated)`` gives degrees. Flags: ``deep_penetration`` of a body more than half buried,
    ``drifted`` beyond ``SLIDE`` or the rotation cap, ``dropped_far`` after a long fall that ends away from the anchor.
    The first two refuse the move: such bodies keep their gap and count as unmoved.
    """
    body = ["mesh_id", *keys[:-1]]
    longest = headers.select("mesh_id", F.greatest("sizex", "sizey", "sizez").alias("_l"), "cell")
    start = M.moments(before, body).select(*body, "radius", *[F.col(f"c{a}").alias(f"s{a}") for a in "xyz"])
    end = after.groupBy(*body).agg(*[F.avg(a).alias(f"e{a}") for a in "xyz"])
    gap = body_gap(measured(before, triangles, bricks, headers, keys), keys).select(*body, "field_min", "gap")
    then = body_gap(measured(after, triangles, bricks, headers, keys), keys).select(
        *body, F.col("gap").alias("_after"), F.col("field_min").alias("_closest"))
    slide = support_drift(before, after, keys).select(*body, "drift")
    rows = gap.join(then, body).join(start, body).join(end, body).join(slide, body).join(turned, body).join(longest, "mesh_id")
    share = lambda c: c / F.col("_l")
    travel = G.norm(tuple(F.col(f"e{a}") - F.col(f"s{a}") for a in "xyz"))
    placed = rows.select(
        *body, share(F.col("gap")).alias("gap"), share(F.greatest(F.lit(0.0), -F.col("field_min"))).alias("depth"),
        share(F.col("radius")).alias("radius"), share(F.col("sy") - F.col("ey")).alias("drop"), share(F.col("drift")).alias("drift"),
        share(travel).alias("_moved"), share(F.col("_after")).alias("_after"), "rotated",
        (F.col("_closest") < F.col("cell")).alias("_near"),
    )
    deep, drifted, far = contact_tests(
        F.col("gap"), F.col("radius"), F.col("drop"), F.col("_near"), F.col("drift"),
        F.greatest(F.lit(SLIDE), SLIDE_SHARE * F.col("radius")), F.col("rotated"))
    refused = deep | drifted
    flags = F.array_compact(F.array(F.when(deep, "deep_penetration"), F.when(~deep & drifted, "drifted"), F.when(~refused & far, "dropped_far")))
    return placed.select(
        *body, "gap", "depth", "radius", "drop", "drift", F.when(refused, 0.0).otherwise(F.col("_moved")).alias("moved"),
        F.when(refused, 0.0).otherwise(F.col("rotated")).alias("rotated"),
        F.when(refused, F.col("gap")).otherwise(F.col("_after")).alias("gap_after"), flags.alias("flags"),
    )


def contact_tests(gap: Column, radius: Column, drop: Column, near: Column, drift: Column, budget: Column, rotated: Column) -> list[Column]:
    """Deep penetration, drift and a far drop of one placement; lengths are in units of the anchor's longest side."""
    return [gap < -radius, (drift > budget) | (rotated > ROTATION_CAP), (drop > F.greatest(F.lit(0.35), 3 * radius)) & ~near]


def directional_gap(points: DataFrame, triangles: DataFrame, direction: tuple[float, float, float], ground: Column | None = None,
                    keys: Sequence[str] = ("point_id",), band: float = BAND_CELLS) -> DataFrame:
    """Distance left along ``direction`` per body; null when nothing ahead is within ``band`` cells.

    ``points`` come from ``measured`` with at least that reach. A sample counts when its field value is at most the band,
    its surface faces the motion and its witness lies along the motion; a touching triangle must oppose it squarely.
    """
    body = ["mesh_id", *keys[:-1]]
    d = G.literal(direction)
    reach = band * F.col("cell")
    facing = (F.col("phi") <= reach) & (F.col("dist") <= reach) & (G.dot(G.vec("grad"), d) <= -0.5)
    shapes = triangles.select("mesh_id", "tri_id", *M.COORDS)
    met = points.where(facing).join(shapes, ["mesh_id", "tri_id"])
    normal = G.triangle_cross(*M.corners())
    length = G.norm(normal)
    blocking = (length > 1e-12) & (F.abs(G.dot(normal, d)) >= BLOCKING * length)
    along = G.dot(G.sub(G.vec("w"), G.vec("")), d)
    counts = F.when(F.col("dist") < TOUCH, blocking).otherwise(F.abs(along) >= 0.5 * F.col("dist"))
    gaps = met.where(counts).select(*body, F.col("dist").alias("g"))
    if ground is not None and direction[1] < -0.5:
        gaps = gaps.unionByName(points.select(*body, (F.col("y") - ground).alias("g")))
    found = gaps.groupBy(*body).agg(F.min("g").alias("gap"))
    return points.select(*body).distinct().join(found, body, "left")


def embed_depth(points: DataFrame, direction: G.Vec, fraction: Column) -> DataFrame:
    """Target depth of an embed: a clamped share of the body's extent along the direction."""
    along = G.dot(G.vec(""), direction)
    extent = points.groupBy("mesh_id").agg(
        (F.max(along) - F.min(along)).alias("extent"), F.max(fraction).alias("_f")
    )
    share = F.least(F.greatest(F.coalesce("_f", F.lit(0.0)), F.lit(EMBED_LEAST)), F.lit(EMBED_MOST))
    depth = -F.least(share * F.col("extent"), EMBED_SHARE * F.col("extent"))
    return extent.select("mesh_id", "extent", depth.alias("depth"))


def displacement(before: DataFrame, after: DataFrame) -> DataFrame:
    """Mean distance moved and lowest height after, per mesh, between two states of one point set."""
    now = after.select("mesh_id", "point_id", *[F.col(a).alias(f"{a}2") for a in "xyz"])
    far = G.norm(tuple(F.col(f"{a}2") - F.col(a) for a in "xyz"))
    return before.join(now, ["mesh_id", "point_id"]).groupBy("mesh_id").agg(
        F.avg(far).alias("moved"), F.min("y2").alias("lowest")
    )


def support_drift(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("point_id",)) -> DataFrame:
    """Horizontal travel ``drift`` of the point of each body that was lowest (ties: the smaller id)."""
    body, point = ["mesh_id", *keys[:-1]], keys[-1]
    pivot = before.groupBy(*body).agg(F.min(F.struct("y", point, "x", "z")).alias("p"))
    start = pivot.select(*body, f"p.{point}", "p.x", "p.z")
    now = after.select(*body, point, F.col("x").alias("x2"), F.col("z").alias("z2"))
    drift = F.sqrt((F.col("x2") - F.col("x")) ** 2 + (F.col("z2") - F.col("z")) ** 2)
    return start.join(now, [*body, point]).select(*body, point, drift.alias("drift"))
