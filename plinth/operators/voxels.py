"""Voxel grids over triangle tables: headers, rasterisation, fill, blocks, distance fields.

A grid is sparse: ``cells(mesh_id, x, y, z)`` or runs of cells along x, plus one header row per mesh. Triangles are reduced
to distinct cells before they meet. A group is a line or a slab of a grid (at most ``resolution`` cells a side, 128 in
practice); no row or task holds a whole grid.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.functions import vectors as G
from plinth.operators import meshes as M
from plinth.operators.components import GROUND, grounded_labels
from plinth.runtime import cut, large, spread

SAMPLES_PER_CELL = 2
SUBDIVISION = 3
MIN_FILL = 0.2
FIELD_PAD = 3
CELL = ["mesh_id", "x", "y", "z"]
NUMBER_OF = {"x": "nx", "y": "ny", "z": "nz"}


def grid_headers(triangles: DataFrame, resolution: int, pad: int = 0) -> DataFrame:
    """One row per mesh: cubic ``cell``, ``nx ny nz`` and the grid's lower corner ``gx gy gz``.

    ``pad`` adds clear cells on every side. Degenerate meshes have no grid and are left out;
    ``meshes.bounds`` reports them.
    """
    boxes = M.bounds(triangles).where(~F.col("degenerate"))
    sized = boxes.withColumn("cell", F.col("longest") / F.lit(float(resolution)))
    counted = sized.select(
        "*", *[(F.greatest(F.lit(1), F.ceil(F.col(f"size{a}") / F.col("cell"))) + 2 * pad).cast("int").alias(f"n{a}")
               for a in "xyz"],
    )
    # A table, since many steps read it and its measured size decides how they join it.
    return cut(counted.select(
        "mesh_id", "cell", "nx", "ny", "nz",
        *[(F.col(f"mid{a}") - F.col(f"n{a}") * F.col("cell") / 2).alias(f"g{a}") for a in "xyz"],
        *[f"mid{a}" for a in "xyz"], *[f"size{a}" for a in "xyz"],
    ))


def subdivide(headers: DataFrame, parts: int) -> DataFrame:
    """The same grids with every cell cut into ``parts`` along each axis."""
    fine = {f"n{a}": F.col(f"n{a}") * parts for a in "xyz"}
    return headers.withColumns({**fine, "cell": F.col("cell") / parts})


def surface_cells(triangles: DataFrame, headers: DataFrame) -> DataFrame:
    """Distinct cells touched by a half-cell barycentric lattice over every triangle.

    A triangle's lattice is bounded by the resolution (its edges fit in the grid). Along a line of the lattice only the
    points that enter another cell become rows; the others go within compiled code, before anything is hashed or shuffled.
    """
    a, b, c = M.corners()
    u, v = G.sub(b, a), G.sub(c, a)
    longest = F.greatest(G.norm(u), G.norm(v), G.norm(G.sub(v, u)))
    steps = F.greatest(F.lit(1), F.ceil(longest / (F.col("cell") / SAMPLES_PER_CELL))).cast("int")
    grid = headers.select("mesh_id", "cell", "nx", "ny", "nz", "gx", "gy", "gz")
    joined = spread(triangles, "mesh_id", "tri_id").join(grid, "mesh_id").withColumn("n", steps)
    lines = joined.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n"))))
    start = G.add(a, G.scaled(u, F.col("i") / F.col("n")))
    lines = lines.select(*grid.columns, "n", "i", *[p.alias(f"s{axis}") for p, axis in zip(start, "xyz")], *[d.alias(f"d{axis}") for d, axis in zip(v, "xyz")])
    lattice = lines.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("i"))))

    def cell(j: Column) -> list[Column]:
        return [clamped_cell(p, axis) for p, axis in zip(G.add(G.vec("s"), G.scaled(G.vec("d"), j / F.col("n"))), "xyz")]

    here, before = cell(F.col("j")), cell(F.col("j") - 1)
    enters = (F.col("j") == 0) | (here[0] != before[0]) | (here[1] != before[1]) | (here[2] != before[2])
    return lattice.where(enters).select("mesh_id", *[c.alias(axis) for c, axis in zip(here, "xyz")]).distinct()


def cell_index(value: Column, axis: str) -> Column:
    return F.floor((value - F.col(f"g{axis}")) / F.col("cell"))


def clamped_cell(value: Column, axis: str) -> Column:
    return F.least(F.col(f"n{axis}") - 1, F.greatest(F.lit(0), cell_index(value, axis))).cast("int")


def filled_runs(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """Surface plus enclosed cells (6-connected outside-in fill) as disjoint runs ``mesh_id, y, z, x0, x1`` along x.

    Only a gap between two surface cells of a grid line can be enclosed; all other empty cells reach the border along
    their line. Gaps that overlap in neighbouring lines are connected; one is a seed if it lies in a border line or if a
    neighbouring line is open somewhere beside it. Components that hold a seed are outside. No step holds a whole grid.
    """
    line = ["mesh_id", "y", "z"]
    cells = cut(cells)
    before = F.lag("x").over(Window.partitionBy(*line).orderBy("x"))
    gaps = cut(
        cells.withColumn("_before", before).where(F.col("x") - F.col("_before") > 1)
        .join(headers.select("mesh_id", "nx", "ny", "nz"), "mesh_id")
        .select(
            *line, (F.col("_before") + 1).alias("x0"), (F.col("x") - 1).alias("x1"),
            ((F.col("y").cast("long") * F.col("nz") + F.col("z")) * F.col("nx") + F.col("_before") + 1).alias("id"),
            ((F.col("y") == 0) | (F.col("z") == 0) | (F.col("y") == F.col("ny") - 1) | (F.col("z") == F.col("nz") - 1)).alias("edge"),
        )
    )
    spans = cells.groupBy(*line).agg(F.min("x").alias("first"), F.max("x").alias("last"))
    steps = lambda pairs: F.explode(F.array(*[F.struct(F.lit(p).alias("dy"), F.lit(q).alias("dz")) for p, q in pairs]))

    def beside(pairs) -> DataFrame:
        moved = gaps.withColumn("s", steps(pairs))
        return moved.select("mesh_id", (F.col("y") + F.col("s.dy")).alias("y"), (F.col("z") + F.col("s.dz")).alias("z"),
                            F.col("x0").alias("a0"), F.col("x1").alias("a1"), F.col("id").alias("a"), F.col("edge").alias("_edge"))

    shut = F.coalesce((F.col("first") <= F.col("a0")) & (F.col("a1") <= F.col("last")), F.lit(False))
    nodes = beside([(1, 0), (-1, 0), (0, 1), (0, -1)]).join(large(spans), line, "left").groupBy("mesh_id", F.col("a").alias("id")).agg(
        F.max(F.col("_edge") | ~shut).alias("seed"))
    edges = beside([(1, 0), (0, 1)]).join(large(gaps), line).where("a0 <= x1 AND x0 <= a1").select("mesh_id", "a", F.col("id").alias("b"))
    labels = grounded_labels(nodes, edges, ["mesh_id"])
    held = gaps.join(large(labels), ["mesh_id", "id"]).where(F.col("label") != GROUND).select(*line, "x0", "x1")
    return cells.select(*line, F.col("x").alias("x0"), F.col("x").alias("x1")).unionByName(held)


def run_cells(found: DataFrame) -> DataFrame:
    """Cells of runs along x."""
    return found.select("mesh_id", F.explode(F.sequence("x0", "x1")).alias("x"), "y", "z")


def filled_cells(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """The cells of ``filled_runs``."""
    return run_cells(filled_runs(cells, headers))


def downsample(found: DataFrame, parts: int = SUBDIVISION, min_fill: float = MIN_FILL) -> DataFrame:
    """Coarse cells whose filled share of sub-cells exceeds ``min_fill``, from disjoint fine runs along x.

    A run counts once per coarse cell it passes, with the number of sub-cells it fills there.
    """
    least = int(parts**3 * min_fill) + 1
    over = lambda c: F.floor(F.col(c) / parts).cast("int")
    passed = found.select("mesh_id", over("y").alias("y"), over("z").alias("z"), "x0", "x1", F.explode(F.sequence(over("x0"), over("x1"))).alias("x"))
    held = F.least(F.col("x1"), (F.col("x") + 1) * parts - 1) - F.greatest(F.col("x0"), F.col("x") * parts) + 1
    return passed.groupBy("mesh_id", "x", "y", "z").agg(F.sum(held).alias("_held")).where(F.col("_held") >= least).drop("_held")


def solid_cells(triangles: DataFrame, headers: DataFrame) -> DataFrame:
    """Rasterise on the subdivided grid, fill, then downsample."""
    fine = subdivide(headers, SUBDIVISION)
    return downsample(filled_runs(surface_cells(triangles, fine), fine))


# ---- runs and blocks --------------------------------------------------------------------

def runs(cells: DataFrame, along: str, keys: list[str], first: str, last: str) -> DataFrame:
    """Gaps and islands: maximal unbroken runs of ``along`` within ``keys`` (a grid line)."""
    window = Window.partitionBy(*keys).orderBy(along)
    island = F.col(along) - F.row_number().over(window)
    return (
        cells.withColumn("_island", island)
        .groupBy(*keys, "_island")
        .agg(F.min(along).alias(first), F.max(along).alias(last))
        .drop("_island")
    )


AXIS_ORDERS = ["xyz", "xzy", "yxz", "yzx", "zxy", "zyx"]


def blocks(cells: DataFrame) -> DataFrame:
    """Disjoint boxes that cover the cells exactly, largest first.

    Cells merge to runs along the first axis of an order, equal runs to slabs along the second, equal slabs to boxes along
    the third. All six orders are tried and the one with fewest boxes wins per mesh. Two orders share each first axis, so
    a cell is read three times and only its runs, which are far fewer, six times. Bounds are half-open: ``x0 <= x < x1``.
    """
    number = {order: k for k, order in enumerate(AXIS_ORDERS)}
    first = F.explode(F.array(*[
        F.struct(F.lit(axis).alias("first"), *[F.col(a).alias(n) for a, n in zip([axis, *[o for o in "xyz" if o != axis]], "puv")]) for axis in "xyz"
    ]))
    copies = spread(cells.select("mesh_id", first.alias("o")).select("mesh_id", "o.*"), "mesh_id", "first", "u")
    lines = runs(copies, "p", ["mesh_id", "first", "u", "v"], "p0", "p1")
    ways = []
    for axis in "xyz":
        u, v = (o for o in "xyz" if o != axis)
        ways += [(axis, number[axis + u + v], "u", "v"), (axis, number[axis + v + u], "v", "u")]
    second = F.explode(F.filter(F.array(*[
        F.struct(F.lit(axis).alias("first"), F.lit(k).alias("ord"), F.col(q).alias("q"), F.col(r).alias("r")) for axis, k, q, r in ways
    ]), lambda w: w["first"] == F.col("first")))
    key = ["mesh_id", "ord"]
    tried = spread(lines.select("mesh_id", "p0", "p1", second.alias("w")).select("mesh_id", "w.ord", "w.q", "w.r", "p0", "p1"), *key)
    slabs = runs(tried, "q", [*key, "r", "p0", "p1"], "q0", "q1")
    boxes = runs(slabs, "r", [*key, "p0", "p1", "q0", "q1"], "r0", "r1")
    sized = boxes.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
    best = Window.partitionBy("mesh_id")
    kept = sized.withColumn("_best", F.min(F.struct("_n", "ord")).over(best)).where(F.col("ord") == F.col("_best.ord"))

    def axis(a: str, end: str) -> Column:
        out = F.lit(None)
        for k, order in enumerate(AXIS_ORDERS):
            out = F.when(F.col("ord") == k, F.col("pqr"[order.index(a)] + end)).otherwise(out)
        return out

    placed = kept.select(
        "mesh_id",
        *[axis(a, "0").alias(f"{a}0") for a in "xyz"],
        *[(axis(a, "1") + 1).alias(f"{a}1") for a in "xyz"],
    )
    return largest_first(placed)


def volume() -> Column:
    return ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) * (F.col("z1") - F.col("z0"))).cast("long")


def largest_first(boxes: DataFrame) -> DataFrame:
    """Rank blocks of a mesh by volume, ties by position (a mesh has at most a grid of blocks)."""
    order = Window.partitionBy("mesh_id").orderBy(F.col("volume").desc(), "x0", "y0", "z0")
    return boxes.withColumn("volume", volume()).withColumn("rank", F.row_number().over(order))


def block_cells(boxes: DataFrame) -> DataFrame:
    """Inverse of ``blocks``."""
    out = boxes.select("mesh_id", "x0", "y0", "z0", "x1", "y1", "z1")
    for axis in "xyz":
        out = out.withColumn(axis, F.explode(F.sequence(F.col(f"{axis}0"), F.col(f"{axis}1") - 1)))
    return out.select(*CELL)


def world_blocks(boxes: DataFrame, headers: DataFrame) -> DataFrame:
    """Block corners in the mesh's centred frame, rounded just past cell precision."""
    decimals = F.greatest(F.lit(0), F.ceil(-F.log10("cell")) + 1).cast("int")
    factor = F.pow(F.lit(10.0), decimals)
    corner = lambda a, k: (
        F.round((F.col(f"{a}{k}") - F.col(f"n{a}") / 2) * F.col("cell") * factor) / factor + F.lit(0.0)
    )
    joined = boxes.join(headers.select("mesh_id", "cell", "nx", "ny", "nz"), "mesh_id")
    return joined.select(
        "mesh_id", "rank", "volume",
        *[corner(a, k).alias(f"{a}{k}") for k in (0, 1) for a in "xyz"],
    )


# ---- signed distance field --------------------------------------------------------------

FAR = 1 << 28  # squared distance, in cells, where a line holds no site; far beyond any grid


def envelope(f: np.ndarray) -> np.ndarray:
    """``min over p of (q - p)^2 + f[p]`` for every place q of each column of ``f``, in one pass along the columns.

    A column's lower envelope of parabolas is kept as a stack. A new parabola takes off those it undercuts, so each goes
    on and off once: work grows with the cells, not with the square of a line. All columns advance together.
    """
    n, m = f.shape
    f = f.astype(np.float64)
    place, edge = np.zeros((n, m), dtype=np.int64), np.full((n + 1, m), np.inf)
    edge[0] = -np.inf
    top, every = np.zeros(m, dtype=np.int64), np.arange(m)
    height = f + (np.arange(n, dtype=np.float64) ** 2)[:, None]
    for q in range(1, n):
        open_, cross = every, np.empty(m)
        while len(open_):
            held = place[top[open_], open_]
            met = (height[q, open_] - height[held, open_]) / (2.0 * (q - held))
            cross[open_] = met
            under = met <= edge[top[open_], open_]
            open_ = open_[under]
            top[open_] -= 1
        top += 1
        place[top, every], edge[top, every] = q, cross
        edge[np.minimum(top + 1, n), every] = np.inf
    out = np.empty((n, m))
    at = np.zeros(m, dtype=np.int64)
    for q in range(n):
        open_ = every
        while len(open_):
            open_ = open_[edge[at[open_] + 1, open_] < q]
            at[open_] += 1
        held = place[at, every]
        out[q] = (q - held) ** 2 + f[held, every]
    return np.minimum(out, FAR).astype(np.int64)


def nearest_site(site: np.ndarray) -> np.ndarray:
    """Squared distance to the nearest true cell along the last axis; ``FAR`` where there is none."""
    n = site.shape[-1]
    places = np.arange(n)
    left = np.maximum.accumulate(np.where(site, places, -FAR), axis=-1)
    right = np.minimum.accumulate(np.where(site, places, 2 * FAR)[..., ::-1], axis=-1)[..., ::-1]
    near = np.minimum(places - left, right - places).astype(np.int64)
    return np.where(near < FAR, near * near, FAR)


def _alike(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in groups whose lines have the same length, which can then advance together."""
    size = batch.column(column).to_numpy()
    for n in np.unique(size):
        yield batch.take(pa.array(np.flatnonzero(size == n)))


def _columns(blocks: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    return np.concatenate(blocks, axis=1), np.cumsum([b.shape[1] for b in blocks])[:-1].tolist()


_LINES = pa.list_(pa.int32())


def _slab_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slabs of constant y: passes along x and z, then one row per line along x with both squared distances."""
    for batch in batches:
        for alike in _alike(batch, "nz"):
            sides = []
            for i in range(alike.num_rows):
                nx, nz = alike.column("nx")[i].as_py(), alike.column("nz")[i].as_py()
                change = np.zeros((nz, nx + 1), dtype=np.int32)
                runs_ = alike.column("runs")[i].values
                if runs_ is not None and len(runs_):
                    z, x0, x1 = (runs_.field(c).to_numpy() for c in ("z", "x0", "x1"))
                    np.add.at(change, (z, x0), 1)
                    np.add.at(change, (z, x1 + 1), -1)
                solid = change.cumsum(axis=1)[:, :nx] > 0
                sides += [nearest_site(solid), nearest_site(~solid)]
            whole, cuts = _columns(sides)
            done = np.split(envelope(whole), cuts, axis=1)
            for i in range(alike.num_rows):
                out, inner = done[2 * i], done[2 * i + 1]
                nz = len(out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([alike.column("mesh_id")[i].as_py()] * nz, pa.int64()), pa.array([alike.column("y")[i].as_py()] * nz, pa.int32()),
                     pa.array(np.arange(nz), pa.int32()), pa.array(list(out), _LINES), pa.array(list(inner), _LINES)],
                    names=["mesh_id", "y", "z", "o", "i"],
                )


def _last_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slabs of constant z: the pass along y and the signed distance, one row per line along x."""
    for batch in batches:
        for alike in _alike(batch, "ny"):
            sides = []
            for i in range(alike.num_rows):
                lines = alike.column("lines")[i].values
                order = np.argsort(lines.field("y").to_numpy())
                for side in "oi":
                    sides.append(lines.field(side).flatten().to_numpy().reshape(len(order), -1)[order])
            whole, cuts = _columns(sides)
            done = np.split(envelope(whole), cuts, axis=1)
            for i in range(alike.num_rows):
                out, inner = done[2 * i], done[2 * i + 1]
                ny = len(out)
                value = np.where(out == 0, -np.sqrt(inner), np.sqrt(out)) * alike.column("cell")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([alike.column("mesh_id")[i].as_py()] * ny, pa.int64()), pa.array(np.arange(ny), pa.int32()),
                     pa.array([alike.column("z")[i].as_py()] * ny, pa.int32()), pa.array(list(value), pa.list_(pa.float64()))],
                    names=["mesh_id", "y", "z", "phi"],
                )


def signed_distance(found: DataFrame, headers: DataFrame) -> DataFrame:
    """Exact signed distance at cell centres: positive outside, negative inside, world units.

    ``found`` holds the solid as runs along x. Three passes, one per axis, each linear in the cells. Work is dealt by
    (mesh, y) for the first two and by (mesh, z) for the last, so that a group is one slab of the grid; lines cross the
    one shuffle between them as arrays. Every mesh needs a solid cell, as any header's mesh has.
    """
    slabs = headers.select("mesh_id", "nx", "nz", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)).alias("y"))
    held = found.groupBy("mesh_id", "y").agg(F.collect_list(F.struct("z", "x0", "x1")).alias("runs"))
    first = spread(slabs.join(large(held), ["mesh_id", "y"], "left").select("mesh_id", "y", "nx", "nz", F.coalesce("runs", F.expr(
        "cast(array() AS array<struct<z: int, x0: int, x1: int>>)")).alias("runs")), "mesh_id", "y")
    lines = first.mapInArrow(_slab_pass, "mesh_id long, y int, z int, o array<int>, i array<int>")
    second = spread(lines, "mesh_id", "z").groupBy("mesh_id", "z").agg(F.collect_list(F.struct("y", "o", "i")).alias("lines"))
    last = second.join(headers.select("mesh_id", "ny", "cell"), "mesh_id").mapInArrow(
        _last_pass, "mesh_id long, y int, z int, phi array<double>")
    return last.select("mesh_id", "y", "z", F.posexplode("phi").alias("x", "phi")).select(*CELL, "phi")


def distance_field(triangles: DataFrame, resolution: int) -> tuple[DataFrame, DataFrame]:
    """``(phi, headers)`` of padded, filled grids over the meshes."""
    headers = grid_headers(triangles, resolution, FIELD_PAD)
    return signed_distance(filled_runs(surface_cells(triangles, headers), headers), headers), headers


# ---- lattice ----------------------------------------------------------------------------

# Neighbour offsets by role, positive directions only.
STRETCH = [(1, 0, 0), (0, 1, 0), (0, 0, 1)]
SHEAR = [
    (1, 1, 0), (1, -1, 0), (1, 0, 1), (1, 0, -1), (0, 1, 1), (0, 1, -1),
    (1, 1, 1), (1, 1, -1), (1, -1, 1), (1, -1, -1),
]
BEND = [(2, 0, 0), (0, 2, 0), (0, 0, 2)]
LINKS = [("stretch", o) for o in STRETCH] + [("shear", o) for o in SHEAR] + [("bend", o) for o in BEND]


def lattice(triangles: DataFrame, resolution: int) -> tuple[DataFrame, DataFrame]:
    """``(nodes, headers)``: a node at the centre of every surface cell, one clear cell around."""
    headers = grid_headers(triangles, resolution, 1)
    return surface_cells(triangles, headers), headers


def links(nodes: DataFrame, headers: DataFrame) -> DataFrame:
    """Typed neighbour links with rest length: sixteen shifted copies, one equi-join, no pairs."""
    offsets = F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), *[F.lit(v).alias(f"o{a}") for v, a in zip(offset, "xyz")])
        for kind, offset in LINKS
    ]))
    nodes = cut(nodes)
    wanted = nodes.select(*CELL, offsets.alias("o")).select(
        "mesh_id", "x", "y", "z", "o.*", *[(F.col(a) + F.col(f"o.o{a}")).alias(f"{a}2") for a in "xyz"]
    )
    present = nodes.select("mesh_id", *[F.col(a).alias(f"{a}2") for a in "xyz"])
    length = F.sqrt((F.col("ox") * F.col("ox") + F.col("oy") * F.col("oy") + F.col("oz") * F.col("oz")).cast("double"))
    return (
        wanted.join(large(present), ["mesh_id", "x2", "y2", "z2"])
        .join(headers.select("mesh_id", "cell"), "mesh_id")
        .select("mesh_id", "x", "y", "z", "x2", "y2", "z2", "kind", (length * F.col("cell")).alias("rest"))
    )
