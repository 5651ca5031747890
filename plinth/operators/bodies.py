"""Fields read by posed bodies, in NumPy inside Arrow tasks.

A body is a mesh's points under a pose in the frame of its anchor. Bodies times points are far more than either, so rows of
bodies are dealt to tasks, and a task reads the points of a body's mesh and the field of its anchor when it meets them.
Where only the least value of a body counts, points lie in groups of ``GROUP`` neighbours: a field changes by no more than
its steepest step along a way, so the value at a group's middle tells whether a point of the group can be the least.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.operators import poses as PO
from plinth.operators.parts import NO_ID, Parts, chunks, ids, stored, with_nulls
from plinth.operators.surfaces import interleaved

SLICE = 1 << 14        # places that are sampled at once, so that their arrays stay in the cache
HELD = 1 << 22         # bounds of bodies and groups that are held at once
GROUP = 32             # neighbouring points of a mesh that are ruled out together
SURE = 1e-9            # share of a value that rounding stays below
GRID = ["cell", *[n + a for n in "ng" for a in "xyz"]]
POSE = [*PO.ROTATION, "scale", *PO.CENTRE, *[e + a for e in ("_o", "_a") for a in "xyz"]]


def rounded(value: np.ndarray, digits: int) -> np.ndarray:
    """Halves away from zero, as SQL does, and no negative zero."""
    scaled = value * 10.0**digits
    whole = np.trunc(scaled)
    out = (whole + np.where(np.abs(scaled - whole) >= 0.5, np.copysign(1.0, scaled), 0.0)) / 10.0**digits
    return np.where(np.isfinite(out), out, value) + 0.0


class Field:
    """A grid of values, sampled trilinearly; beyond it a safe lower bound."""

    def __init__(self, table: pa.Table):
        first = {c: table.column(c)[0].as_py() for c in GRID}
        self.n, self.g, self.cell = [first[f"n{a}"] for a in "xyz"], [first[f"g{a}"] for a in "xyz"], first["cell"]
        x, y, z = (table.column(a).to_numpy().astype(np.int64) for a in "xyz")
        grid = np.full(self.n, np.nan)
        grid[x, y, z] = table.column("phi").to_numpy()
        self.values = grid.ravel()
        steps = []
        for axis in range(3):
            step = np.abs(np.diff(grid, axis=axis))
            for other in {0, 1, 2} - {axis}:
                low, high = (np.take(step, range(k, step.shape[other] - 1 + k), axis=other) for k in (0, 1))
                step = np.maximum(low, high)
            steps.append(step)
        self.steepest = float(np.sqrt(sum(step * step for step in steps)).max()) / self.cell  # NaN where values are unknown: rules nothing out

    def nbytes(self) -> int:
        return self.values.nbytes

    def parts(self, at) -> tuple[np.ndarray, np.ndarray]:
        """The value at the nearest place inside, and how far that is."""
        base, weights, beyond = 0, [], 0.0
        for a, where in enumerate(at):
            raw = (where - self.g[a]) / self.cell - 0.5
            held = np.maximum(np.fmin(raw, self.n[a] - 1.001), 0.0)
            off = (raw - held) * self.cell
            beyond = beyond + off * off
            low = np.floor(held)
            base = base * self.n[a] + low.astype(np.int64)
            weights.append((1 - (held - low), held - low))
        value = 0.0
        for i in (0, 1):
            for j in (0, 1):
                flat = weights[0][i] * weights[1][j]
                for k in (0, 1):
                    value = value + self.values.take(base + ((i * self.n[1] + j) * self.n[2] + k)) * (flat * weights[2][k])
        return value, np.sqrt(beyond)

    def sample(self, at, unknown: np.ndarray) -> np.ndarray:
        """Values at ``at``; an ``unknown`` place counts as one at the far end of the grid, as nulls do in SQL."""
        value, beyond = self.parts(at)
        return np.where((beyond == 0) | unknown, value, np.maximum(beyond, value - beyond))

    def gradient(self, at, unknown: np.ndarray) -> list[np.ndarray]:
        """Unit central differences half a cell away, +Y where it is flat."""
        g, half = [], 0.5 * self.cell
        for axis in range(3):
            ends = [self.sample([c + way if a == axis else c for a, c in enumerate(at)], unknown) for way in (half, -half)]
            g.append(ends[0] - ends[1])
        length = np.sqrt(g[0] * g[0] + g[1] * g[1] + g[2] * g[2])
        steep = length > 1e-12
        return [np.where(steep, c / np.where(steep, length, 1.0), flat) for c, flat in zip(g, (0.0, 1.0, 0.0))]

    def least_near(self, at, radius: np.ndarray) -> np.ndarray:
        """No sample within ``radius`` of ``at`` is smaller."""
        value, beyond = self.parts(at)
        low = np.fmax(value - beyond - (self.steepest + 1) * radius, np.where(beyond > radius, beyond - radius, -np.inf))
        return np.where(np.isnan(self.steepest), -np.inf, low) - SURE * (np.abs(value) + beyond + radius)


class Points:
    """Points of a mesh in groups of neighbours, by place; ``unknown`` ones, with a null coordinate, lie in the last groups."""

    def __init__(self, table: pa.Table):
        self.ids = ids(table.column("point_id"))
        coordinates = [table.column(a) for a in "xyz"]
        self.unknown = np.logical_or.reduce([c.is_null().to_numpy() for c in coordinates])
        p = np.stack([c.to_numpy().astype(float) for c in coordinates])
        fine = np.isfinite(p).all(axis=0)
        low, high = (end(p, axis=1, where=fine, initial=start) for end, start in ((np.min, np.inf), (np.max, -np.inf)))
        cell = np.where(fine, (p - low[:, None]) / np.maximum(high - low, 1e-300).max(initial=1e-300), 0.0) * 1023
        order = np.lexsort((self.ids, np.where(fine, interleaved(cell.T), np.int64(1) << 62)))
        self.ids, self.unknown, self.p = self.ids[order], self.unknown[order], p[:, order]
        n = len(self.ids)
        self.groups = np.minimum(np.arange(-(-n // GROUP) * GROUP), n - 1).reshape(-1, GROUP)  # the last one is filled up with its last point
        held = self.p[:, self.groups]
        self.middles = held.mean(axis=2)
        self.radii = np.sqrt(((held - self.middles[:, :, None]) ** 2).sum(axis=0)).max(axis=1)

    def nbytes(self) -> int:
        return 60 * len(self.ids)


def placed(pose: dict[str, np.ndarray], p) -> list[np.ndarray]:
    """Points ``p`` in the frame of the anchor; poses are columns, one row each."""
    x, y, z, w = (pose[c] for c in PO.ROTATION)
    v = [(p[a] - pose[f"_o{c}"]) * pose["scale"] for a, c in enumerate("xyz")]
    cross = lambda u: (y * u[2] - z * u[1], z * u[0] - x * u[2], x * u[1] - y * u[0])
    t = [c * 2.0 for c in cross(v)]
    return [a + b * w + c + pose[f"c{n}"] + pose[f"_a{n}"] for a, b, c, n in zip(v, t, cross(t), "xyz")]


class Scene:
    """The points and fields that tasks read; ``bodies`` have a row per body with its pose and its anchor's grid."""

    def __init__(self, points: DataFrame, answers: DataFrame, boxes: DataFrame, phi: DataFrame, headers: DataFrame):
        self.points = stored(points.select("mesh_id", "point_id", *[F.col(a).cast("double").alias(a) for a in "xyz"]), "point_id")
        grid = headers.select("mesh_id", *GRID)
        self.fields = stored(phi.select("mesh_id", "x", "y", "z", "phi").join(grid, "mesh_id"), "x", 1 << 62)
        posed = PO.bodies(answers, boxes).select("sample_id", "mesh_id", "anchor_mesh", *[F.col(c).cast("double").alias(c) for c in POSE])
        self.bodies = posed.join(headers.select(F.col("mesh_id").alias("anchor_mesh")), "anchor_mesh")

    def map(self, found: Callable[[pa.Table, dict, Points, Field], Iterator[dict]], schema: str) -> DataFrame:
        """Rows that ``found(bodies, poses, points, field)`` gives for bodies of one mesh beside one anchor and a block of the mesh's points."""
        paths, n = (self.points, self.fields), int(self.bodies.sparkSession.conf.get("spark.sql.shuffle.partitions"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            points, fields = Parts(paths[0], lambda _, t: Points(t)), Parts(paths[1], lambda _, t: Field(t))
            for table in chunks(batches, ["anchor_mesh", "mesh_id"]):
                anchor, mesh = (table.column(c)[0].as_py() for c in ("anchor_mesh", "mesh_id"))
                pose = {c: table.column(c).to_numpy().astype(float)[:, None] for c in POSE}
                pose["unknown"] = np.logical_or.reduce([table.column(c).is_null().to_numpy() for c in POSE])[:, None]
                for field in fields.of(anchor):
                    for block in points.of(mesh):
                        for out in found(table, pose, block, field):
                            yield pa.RecordBatch.from_pydict(out)

        return self.bodies.repartitionByRange(n, "anchor_mesh", "mesh_id", "sample_id").mapInArrow(run, schema)


def _slices(bodies: int, points: int) -> Iterator[tuple[slice, slice]]:
    """Bodies and points that are sampled together."""
    width = min(points, SLICE)
    height = max(1, SLICE // width)
    for i in range(0, bodies, height):
        for j in range(0, points, width):
            yield slice(i, i + height), slice(j, j + width)


def field_samples(scene: Scene, digits: int) -> DataFrame:
    """Value and unit gradient at each point of each body, rounded."""
    def found(table: pa.Table, pose: dict, points: Points, field: Field) -> Iterator[dict]:
        samples = table.column("sample_id").to_numpy()
        for i, j in _slices(len(samples), len(points.ids)):
            at = placed({c: v[i] for c, v in pose.items()}, points.p[:, j])
            shape, at = at[0].shape, [c.ravel() for c in at]
            unknown = (points.unknown[j] | pose["unknown"][i]).ravel()
            values = [field.sample(at, unknown), *field.gradient(at, unknown)]
            yield {"sample_id": np.repeat(samples[i], shape[1]), "point_id": with_nulls(np.tile(points.ids[j], shape[0])),
                   **{c: rounded(v, digits) for c, v in zip(("phi", "gradx", "grady", "gradz"), values)}}

    return scene.map(found, "sample_id long, point_id long, phi double, gradx double, grady double, gradz double")


def _contenders(pose: dict, points: Points, low: Callable, value: Callable) -> Iterator[tuple[np.ndarray, ...]]:
    """Bodies and groups, with places and values of the groups' points, among which is every least value of a body.

    ``low(at, radius)`` bounds the values of a group from below, ``value(at, unknown)`` are values of points.
    """
    bodies, groups = len(pose["scale"]), len(points.radii)
    turn = sum(pose[c] ** 2 for c in PO.ROTATION)
    bounds = np.empty((bodies, groups), dtype=np.float32)
    for i, j in _slices(bodies, groups):
        at = placed({c: v[i] for c, v in pose.items()}, points.middles[:, j])
        radius = points.radii[j] * np.abs(pose["scale"][i]) * np.maximum(turn[i], 1.0) * (1 + SURE)
        bound = np.where(np.isfinite(radius + at[0]), low(at, radius), -np.inf)
        bounds[i, j] = np.nextafter(bound.astype(np.float32), np.float32(-np.inf))

    def tried(b: np.ndarray, g: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        for s in range(0, len(b), SLICE // GROUP):
            some, own = b[s:s + SLICE // GROUP], points.groups[g[s:s + SLICE // GROUP]]
            at = placed({c: v[some] for c, v in pose.items()}, points.p[:, own])
            yield some, own, at, value(at, points.unknown[own] | pose["unknown"][some])

    least, first = np.full(bodies, np.inf), bounds.argmin(axis=1)
    for some, own, at, values in tried(np.arange(bodies), first):
        least[some] = np.fmin.reduce(values, axis=1)
        yield some, own, at, values
    bounds[np.arange(bodies), first] = np.inf
    # A body whose values are all unknown so far has NaN here and tries everything.
    yield from tried(*np.nonzero(~(bounds > (least + SURE * (1 + np.abs(least)))[:, None]) & (bounds < np.inf)))


def lowest_field(scene: Scene, shifts: list[float], ground: float) -> DataFrame:
    """Least of field and height above ``ground`` over each body's points, moved down by each of ``shifts``."""
    def found(table: pa.Table, pose: dict, points: Points, field: Field) -> Iterator[dict]:
        for t in shifts:
            down = lambda at, t=t: [at[0], at[1] - t, at[2]]
            low = lambda at, radius, t=t: np.minimum(field.least_near(down(at), radius), at[1] - t - radius - ground)
            value = lambda at, unknown, t=t: np.fmin(field.sample(down(at), unknown), at[1] - t - ground)
            for s in _some(table.num_rows, points):
                rows = table.slice(s.start, s.stop - s.start)
                held = np.full(rows.num_rows, np.nan)
                for some, _, _, values in _contenders({c: v[s] for c, v in pose.items()}, points, low, value):
                    np.fmin.at(held, some, np.fmin.reduce(values, axis=1))
                yield {"sample_id": rows.column("sample_id").combine_chunks(), "mesh_id": rows.column("anchor_mesh").combine_chunks(),
                       "t": np.full(len(held), t), "least": held}

    parts = scene.map(found, "sample_id long, mesh_id long, t double, least double")
    return parts.groupBy("sample_id", "mesh_id", "t").agg(F.min("least").alias("least"))


def toward_anchor(scene: Scene) -> DataFrame:
    """Direction from each body's closest point toward the anchor, minus the field gradient; near ties go to the lowest id.

    Samples in the same cell layer differ by rounding only, so nine digits decide.
    """
    def found(table: pa.Table, pose: dict, points: Points, field: Field) -> Iterator[dict]:
        for s in _some(table.num_rows, points):
            rows, own = table.slice(s.start, s.stop - s.start), {c: v[s] for c, v in pose.items()}
            n = rows.num_rows
            least, place = np.full(n, np.inf), np.full(n, -1)  # infinite where unknown
            sample = lambda at, unknown: rounded(field.sample(at, unknown), 9)
            for some, group, _, values in _contenders(own, points, lambda at, radius: field.least_near(at, radius) - 1e-9, sample):
                b, which, row = _firsts(some, group, values, points.ids)
                new = (place[b] < 0) | (row < least[b]) | ((row == least[b]) & (points.ids[which] < points.ids[place[b]]))
                least[b[new]], place[b[new]] = row[new], which[new]
            at = placed({c: v[:, 0] for c, v in own.items()}, points.p[:, place])
            away = field.gradient(at, points.unknown[place] | own["unknown"][:, 0])
            yield {"sample_id": rows.column("sample_id").combine_chunks(), "mesh_id": rows.column("anchor_mesh").combine_chunks(), "_phi": least,
                   "point_id": with_nulls(points.ids[place]), **{f"dir{a}": -c for a, c in zip("xyz", away)}}

    parts = scene.map(found, "sample_id long, mesh_id long, _phi double, point_id long, dirx double, diry double, dirz double")
    last = F.col("point_id").isNull().alias("_last")
    best = F.min(F.struct("_phi", last, "point_id", "dirx", "diry", "dirz")).alias("b")
    return parts.groupBy("sample_id", "mesh_id").agg(best).select("sample_id", "mesh_id", "b.*")


def _some(bodies: int, points: Points) -> Iterator[slice]:
    """Bodies whose bounds, one per group of points, are held at once."""
    step = max(1, min(SLICE, HELD // len(points.radii)))
    return (slice(s, min(bodies, s + step)) for s in range(0, bodies, step))


def _firsts(bodies: np.ndarray, group: np.ndarray, values: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bodies, each once, with their least point and its value, ties to the smaller of ``order``; unknown values are infinite."""
    values = np.where(np.isnan(values), np.inf, values)
    at = np.where(values == values.min(axis=1)[:, None], order[group], NO_ID).argmin(axis=1)
    rows = np.arange(len(bodies))
    which, row = group[rows, at], values[rows, at]
    by = np.lexsort((order[which], row, bodies))
    by = by[np.diff(bodies[by], prepend=-1) != 0]
    return bodies[by], which[by], row[by]
