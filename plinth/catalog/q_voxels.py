"""Voxel, field and contact queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from plinth.catalog.q_geometry import matrix, nearest_sql, turned
from plinth.catalog.registry import query
from plinth.catalog.sqlviews import SQL_VIEWS, r6
from plinth.catalog.tables import BOX_RESOLUTION, SOUP_RESOLUTION
from plinth.functions import text as T
from plinth.functions import vectors as G
from plinth.operators import aggregates as A
from plinth.operators import bodies as B
from plinth.operators import meshes as M
from plinth.operators import poses as PO
from plinth.operators import proximity as X
from plinth.operators import voxels as V
from plinth.runtime import cut

FIELD_RESOLUTION = 16
FINE_RESOLUTION = 48
KEYS = ("sample_id", "point_id")


def headers_sql(bounds: str, resolution: int, pad: int = 0, parts: int = 1) -> str:
    n = ", ".join(f"((greatest(1, ceil(size{a} / whole)) + {2 * pad})::INTEGER) AS c{a}" for a in "xyz")
    return f"""
      SELECT mesh_id, whole / {parts} AS cell, {", ".join(f"c{a} * {parts} AS n{a}" for a in "xyz")},
        {", ".join(f"mid{a} - c{a} * whole / 2 AS g{a}" for a in "xyz")}, {", ".join(f"mid{a}, size{a}" for a in "xyz")}
      FROM (SELECT *, {n} FROM (SELECT *, greatest(sizex, sizey, sizez) / {float(resolution)}::DOUBLE AS whole FROM {bounds}))"""


def surface_sql(triangles: str, headers: str) -> str:
    side = lambda p, q: " + ".join(f'("{q}{a}" - "{p}{a}") * ("{q}{a}" - "{p}{a}")' for a in "xyz")
    third = " + ".join(f'(("c{a}" - a{a}) - ("b{a}" - a{a})) * (("c{a}" - a{a}) - ("b{a}" - a{a}))' for a in "xyz")
    longest = f"greatest(sqrt({side('a', 'b')}), sqrt({side('a', 'c')}), sqrt({third}))"
    cells = ", ".join(
        f'least(n{a} - 1, greatest(0, floor((a{a} + ("b{a}" - a{a}) * (i / n) + ("c{a}" - a{a}) * (j / n) - g{a}) / cell)))::INTEGER AS {a}'
        for a in "xyz"
    )
    return f"""
      SELECT DISTINCT mesh_id, {cells} FROM (SELECT *, unnest(range(n - i + 1)) AS j FROM (SELECT *, unnest(range(n + 1)) AS i FROM (
        SELECT t.*, h.* EXCLUDE (mesh_id), greatest(1, ceil({longest} / (cell / 2)))::INTEGER AS n FROM {triangles} t JOIN {headers} h USING (mesh_id))))"""


def add_fill(name: str, headers: str, surface: str) -> None:
    """Views ``<name>_empty``, ``<name>_outside``, ``<name>_solid`` over a grid."""
    SQL_VIEWS[f"{name}_empty"] = f"""
      SELECT mesh_id, x::INTEGER AS x, y::INTEGER AS y, z::INTEGER AS z, x = 0 OR y = 0 OR z = 0 OR x = nx - 1 OR y = ny - 1 OR z = nz - 1 AS edge
      FROM (SELECT *, unnest(range(nx)) AS x FROM (SELECT *, unnest(range(ny)) AS y FROM (SELECT *, unnest(range(nz)) AS z FROM {headers})))
      ANTI JOIN {surface} s USING (mesh_id, x, y, z)"""
    SQL_VIEWS[f"{name}_outside"] = f"""
      SELECT mesh_id, x, y, z FROM {name}_empty WHERE edge
      UNION SELECT e.mesh_id, e.x, e.y, e.z FROM {name}_outside o, (VALUES (1,0,0),(-1,0,0),(0,1,0),(0,-1,0),(0,0,1),(0,0,-1)) d(dx, dy, dz),
        {name}_empty e WHERE e.mesh_id = o.mesh_id AND e.x = o.x + dx AND e.y = o.y + dy AND e.z = o.z + dz"""
    SQL_VIEWS[f"{name}_solid"] = f"""
      SELECT * FROM {surface} UNION SELECT mesh_id, x, y, z FROM {name}_empty ANTI JOIN {name}_outside USING (mesh_id, x, y, z)"""


DOWN = """SELECT mesh_id, (x // 3)::INTEGER AS x, (y // 3)::INTEGER AS y, (z // 3)::INTEGER AS z FROM {0} GROUP BY 1, 2, 3, 4 HAVING count(*) >= 6"""
SQL_VIEWS["soup_head"] = headers_sql("mesh_bounds", SOUP_RESOLUTION)
SQL_VIEWS["soup_cells"] = surface_sql("triangles", "soup_head")
SQL_VIEWS["fine_head"] = headers_sql("mesh_bounds", SOUP_RESOLUTION, parts=3)
SQL_VIEWS["fine_surface"] = surface_sql("triangles", "fine_head")
add_fill("fine", "fine_head", "fine_surface")
SQL_VIEWS["soup_solid"] = DOWN.format("fine_solid")
SQL_VIEWS["bfine_head"] = headers_sql("box_bounds", BOX_RESOLUTION, parts=3)
SQL_VIEWS["bfine_surface"] = surface_sql("boxes", "bfine_head")
# A closed box fills exactly the index ranges its surface spans.
SQL_VIEWS["bfine_solid"] = """
    SELECT mesh_id, x, y, unnest(range(z0, z1 + 1))::INTEGER AS z FROM (SELECT *, unnest(range(y0, y1 + 1))::INTEGER AS y FROM (SELECT *, unnest(range(x0, x1 + 1))::INTEGER AS x FROM (
      SELECT mesh_id, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM bfine_surface GROUP BY mesh_id)))"""
SQL_VIEWS["box_solid"] = DOWN.format("bfine_solid")

_HEAD = ["cell", *[f"g{a}" for a in "xyz"]]


@query("v1_grid_headers", f"""
    SELECT mesh_id, nx, ny, nz, {", ".join(f"{r6(c)} AS {c}" for c in _HEAD)} FROM soup_head
    UNION ALL SELECT -mesh_id - 1, nx, ny, nz, {", ".join(r6(c) for c in _HEAD)} FROM ({headers_sql("box_bounds", BOX_RESOLUTION)})""")
def _(t):
    boxes = V.grid_headers(t.boxes, BOX_RESOLUTION).withColumn("mesh_id", -F.col("mesh_id") - 1)
    both = V.grid_headers(t.triangles, SOUP_RESOLUTION).unionByName(boxes)
    return both.select("mesh_id", "nx", "ny", "nz", *[T.fixed(F.col(c)).alias(c) for c in _HEAD])


@query("v2_surface_cells", "SELECT mesh_id, x, y, z FROM soup_cells UNION ALL SELECT -mesh_id - 1, x, y, z FROM bfine_surface")
def _(t):
    fine = V.subdivide(V.grid_headers(t.kind_boxes, BOX_RESOLUTION), V.SUBDIVISION)
    return t.soup_cells.unionByName(below(t.of_boxes(V.surface_cells(t.kind_boxes, fine))))


def below(boxes):
    """Rows of boxes under negative mesh ids, apart from those of soups."""
    return boxes.withColumn("mesh_id", -F.col("mesh_id") - 1)


def fine_soup(t):
    fine = V.subdivide(V.grid_headers(t.triangles, SOUP_RESOLUTION), V.SUBDIVISION)
    return V.filled_runs(V.surface_cells(t.triangles, fine), fine)


def soup_solid(t):
    return V.downsample(fine_soup(t))


@query("v3_filled_cells", "SELECT mesh_id, x, y, z FROM fine_solid")
def _(t):
    return V.run_cells(fine_soup(t))


@query("v4_downsampled_cells", "SELECT mesh_id, x, y, z FROM soup_solid UNION ALL SELECT -mesh_id - 1, x, y, z FROM box_solid")
def _(t):
    return soup_solid(t).unionByName(below(t.of_boxes(t.kind_cells)))


def add_blocks(name: str, cells: str) -> None:
    """Views of the run-merge over six axis orders; the order with fewest blocks wins per mesh."""
    orders = " UNION ALL ".join(
        f"SELECT mesh_id, {k} AS ord, {o[0]} AS p, {o[1]} AS q, {o[2]} AS r FROM {cells}" for k, o in enumerate(V.AXIS_ORDERS)
    )
    steps = [("lines", orders, "p", "q, r"), ("slabs", f"SELECT * FROM {name}_lines", "q", "r, p0, p1"),
             ("solids", f"SELECT * FROM {name}_slabs", "r", "p0, p1, q0, q1")]
    for step, source, axis, keys in steps:
        SQL_VIEWS[f"{name}_{step}"] = f"""
          SELECT mesh_id, ord, {keys}, min({axis}) AS {axis}0, max({axis}) AS {axis}1 FROM (
            SELECT *, {axis} - row_number() OVER (PARTITION BY mesh_id, ord, {keys} ORDER BY {axis}) AS isl FROM ({source})) GROUP BY mesh_id, ord, {keys}, isl"""
    ends = ", ".join(
        f"[{', '.join('pqr'[o.index(a)] + e for o in V.AXIS_ORDERS)}][ord + 1]{' + 1' if e == '1' else ''} AS {a}{e}" for e in "01" for a in "xyz"
    )
    SQL_VIEWS[f"{name}_blocks"] = f"""
      SELECT *, row_number() OVER (PARTITION BY mesh_id ORDER BY volume DESC, x0, y0, z0) AS rank FROM (
        SELECT *, ((x1 - x0) * (y1 - y0) * (z1 - z0))::BIGINT AS volume FROM (SELECT mesh_id, {ends} FROM {name}_solids s JOIN (
          SELECT mesh_id, arg_min(ord, n * 10 + ord) AS ord FROM (SELECT mesh_id, ord, count(*) AS n FROM {name}_solids GROUP BY ALL) GROUP BY mesh_id) USING (mesh_id, ord)))"""


add_blocks("soup", "soup_solid")
add_blocks("box", "box_solid")
_ENDS = [f"{a}{e}" for e in "01" for a in "xyz"]


@query("v5_blocks", f"SELECT mesh_id, {', '.join(_ENDS)} FROM soup_blocks UNION ALL SELECT -mesh_id - 1, {', '.join(_ENDS)} FROM box_blocks")
def _(t):
    return all_blocks(t)


def all_blocks(t):
    """Blocks of soups and of boxes, the latter found once per kind."""
    boxes = t.of_boxes(V.blocks(t.kind_cells).select("mesh_id", *_ENDS))
    return V.blocks(soup_solid(t)).select("mesh_id", *_ENDS).unionByName(below(boxes))


@query("l2_blocks_largest_first", "SELECT mesh_id, volume, rank FROM soup_blocks")
def _(t):
    return V.blocks(soup_solid(t)).select("mesh_id", "volume", "rank")


@query("v6_block_cells", "SELECT mesh_id, x, y, z FROM soup_solid UNION ALL SELECT -mesh_id - 1, x, y, z FROM box_solid")
def _(t):
    return V.block_cells(all_blocks(t))


_DEC = "greatest(0, ceil(-log10(cell)) + 1)::INTEGER"
_WORLD = lambda a, e: rf"regexp_replace(((round(({a}{e} - n{a} / 2) * cell * pow(10::DOUBLE, {_DEC})) / pow(10::DOUBLE, {_DEC}) + 0.0::DOUBLE)::DECIMAL(24,6))::VARCHAR, '\.?0+$', '')"
_LINE = " || ' to ' || ".join("'(' || " + " || ', ' || ".join(_WORLD(a, e) for a in "xyz") + " || ')'" for e in "01")


@query("v6_block_text", f"""
    SELECT mesh_id, string_agg({_LINE}, chr(10) ORDER BY rank) AS text FROM soup_blocks JOIN soup_head USING (mesh_id) GROUP BY mesh_id""")
def _(t):
    headers = V.grid_headers(t.triangles, SOUP_RESOLUTION)
    return A.block_text(V.world_blocks(V.blocks(soup_solid(t)), headers))


SQL_VIEWS["soup_about"] = f"""
    SELECT mesh_id, 'Size ' || {" || ' by ' || ".join(rf"regexp_replace((round(any_value(size{a}), 4)::DECIMAL(24,6))::VARCHAR, '\.?0+$', '')" for a in "xyz")}
      || ' along x, y and z, middle at the origin; blocks by volume: ' || count(*) || chr(10) || string_agg({_LINE}, chr(10) ORDER BY rank) AS about
    FROM soup_blocks JOIN soup_head USING (mesh_id) GROUP BY mesh_id"""


@query("a22_placement_prompts", """
    SELECT sample_id, md5('Phrase: "thing ' || p.mesh_id || ' beside stand ' || anchor_mesh || '"' || chr(10) || chr(10) || 'Object that stays — "stand ' || anchor_mesh || '"' || chr(10) || a.about
      || chr(10) || chr(10) || 'Object to be put there — "thing ' || p.mesh_id || '"' || chr(10) || b.about) AS prompt
    FROM placements p JOIN soup_about a ON a.mesh_id = anchor_mesh JOIN soup_about b ON b.mesh_id = p.mesh_id""")
def _(t):
    headers = V.grid_headers(t.triangles, SOUP_RESOLUTION)
    blocks = cut(V.blocks(soup_solid(t)))
    about = cut(A.mesh_text(headers, A.block_text(V.world_blocks(blocks, headers)), blocks.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("blocks"))))
    rows = t.placements.join(about, "mesh_id").join(about.select(F.col("mesh_id").alias("anchor_mesh"), F.col("about").alias("anchor_about")), "anchor_mesh")
    thing, stand = (F.concat(F.lit(n), F.col(c).cast("string")) for n, c in (("thing ", "mesh_id"), ("stand ", "anchor_mesh")))
    prompt = A.placement_prompt(F.concat(thing, F.lit(" beside "), stand), stand, F.col("anchor_about"), thing, F.col("about"))
    return rows.select("sample_id", F.md5(prompt).alias("prompt"))


@query("w12_runs", """
    SELECT mesh_id, y, z, min(x) AS x0, max(x) AS x1 FROM (SELECT *, x - row_number() OVER (PARTITION BY mesh_id, y, z ORDER BY x) AS isl FROM soup_cells)
    GROUP BY mesh_id, y, z, isl""")
def _(t):
    return V.runs(t.soup_cells, "x", ["mesh_id", "y", "z"], "x0", "x1")


# ---- distance field ---------------------------------------------------------------------

def add_field(name: str, resolution: int) -> None:
    """Views ``<name>_head``, ``<name>_solid`` and ``<name>_squares``: squared distances, in cells, to the nearest cell of the other kind.

    Minima are taken along x, then z, then y, which is the minimum over the whole grid.
    """
    SQL_VIEWS[f"{name}_head"] = headers_sql("mesh_bounds", resolution, V.FIELD_PAD)
    SQL_VIEWS[f"{name}_surface"] = surface_sql("triangles", f"{name}_head")
    add_fill(name, f"{name}_head", f"{name}_surface")
    SQL_VIEWS[f"{name}_grid"] = f"""
        SELECT g.*, s.mesh_id IS NOT NULL AS solid FROM (SELECT mesh_id, cell, x::INTEGER AS x, y::INTEGER AS y, z::INTEGER AS z FROM (SELECT *, unnest(range(nx)) AS x FROM (
          SELECT *, unnest(range(ny)) AS y FROM (SELECT *, unnest(range(nz)) AS z FROM {name}_head)))) g LEFT JOIN {name}_solid s USING (mesh_id, x, y, z)"""
    before = f"(SELECT mesh_id, x, y, z, CASE WHEN solid THEN 0 END AS o, CASE WHEN solid THEN NULL ELSE 0 END AS i FROM {name}_grid)"
    for axis, rest in (("x", "y, z"), ("z", "x, y"), ("y", "x, z")):
        SQL_VIEWS[f"{name}_along_{axis}"] = f"""
          SELECT a.mesh_id, {rest}, a.{axis}, min(b.o + (a.{axis} - b.{axis}) * (a.{axis} - b.{axis})) AS o, min(b.i + (a.{axis} - b.{axis}) * (a.{axis} - b.{axis})) AS i
          FROM {before} a JOIN {before} b USING (mesh_id, {rest}) GROUP BY a.mesh_id, {rest}, a.{axis}"""
        before = f"{name}_along_{axis}"
    SQL_VIEWS[f"{name}_squares"] = f"SELECT mesh_id, x, y, z, cell, CASE WHEN o = 0 THEN -i ELSE o END AS square FROM {before} JOIN {name}_head USING (mesh_id)"


add_field("sdf", FIELD_RESOLUTION)
SQL_VIEWS["phi"] = "SELECT mesh_id, x, y, z, sign(square) * sqrt(abs(square)) * cell AS phi FROM sdf_squares"
add_field("fsdf", FINE_RESOLUTION)


def field(t):
    """Bricks of the field and headers of the soup meshes; the field is written once and read often."""
    phi, headers = V.distance_field(t.triangles, FIELD_RESOLUTION)
    headers = cut(headers)
    return cut(X.field_bricks(phi, headers)), headers


@query("v7_signed_distance", f"SELECT mesh_id, x, y, z, {r6('phi')} AS phi FROM phi")
def _(t):
    phi, _headers = V.distance_field(t.triangles, FIELD_RESOLUTION)
    return phi.withColumn("phi", T.fixed(F.col("phi")))


@query("v7_fine_field", """
    SELECT mesh_id, x, y, count(*) AS cells, sum(square)::BIGINT AS squares, min(square) AS deepest, max(square) AS farthest,
      sum(square * (z + 1) % 1009)::BIGINT AS digest FROM fsdf_squares GROUP BY mesh_id, x, y""")
def _(t):
    """Every cell of the fine grids, as sums over their lines: squared distances in cells are whole numbers."""
    phi, headers = V.distance_field(t.triangles, FINE_RESOLUTION)
    length = F.col("phi") / F.col("cell")
    square = (F.signum("phi") * F.round(length * length)).cast("long")
    rows = phi.join(headers.select("mesh_id", "cell"), "mesh_id").select("mesh_id", "x", "y", "z", square.alias("square"))
    return rows.groupBy("mesh_id", "x", "y").agg(
        F.count(F.lit(1)).alias("cells"), F.sum("square").alias("squares"), F.min("square").alias("deepest"),
        F.max("square").alias("farthest"), F.sum(F.col("square") * (F.col("z") + 1) % 1009).alias("digest"))


def sampled_sql(source: str, keys: str) -> str:
    """Relation ``(keys, x, y, z, phi)`` of trilinear samples at ``source(mesh_id, keys, x, y, z)``."""
    raw = lambda a: f"(({a} - g{a}) / cell - 0.5)"
    clip = lambda a: f"greatest(0.0::DOUBLE, least({raw(a)}, n{a} - 1.001::DOUBLE))"
    out = " + ".join(f"pow(({raw(a)} - {clip(a)}) * cell, 2)" for a in "xyz")
    weight = " * ".join(f"(CASE WHEN o{a} = 1 THEN u{a} - floor(u{a}) ELSE 1 - (u{a} - floor(u{a})) END)" for a in "xyz")
    return f"""
      SELECT mesh_id, {keys}, x, y, z, CASE WHEN o > 0 THEN greatest(o, v - o) ELSE v END AS phi FROM (
        SELECT s.mesh_id, {", ".join("s." + k.strip() for k in keys.split(","))}, any_value(s.x) AS x, any_value(s.y) AS y, any_value(s.z) AS z, any_value(o) AS o, sum(phi * {weight}) AS v
        FROM (SELECT p.*, {", ".join(f"{clip(a)} AS u{a}" for a in "xyz")}, sqrt({out}) AS o FROM {source} p JOIN sdf_head USING (mesh_id)) s,
          (VALUES {", ".join(f"({n & 1}, {n >> 1 & 1}, {n >> 2 & 1})" for n in range(8))}) c(ox, oy, oz), phi f
        WHERE f.mesh_id = s.mesh_id AND f.x = floor(ux) + ox AND f.y = floor(uy) + oy AND f.z = floor(uz) + oz GROUP BY s.mesh_id, {", ".join("s." + k.strip() for k in keys.split(","))})"""


SQL_VIEWS["placed_rotations"] = SQL_VIEWS["rotations"].replace("FROM poses", "FROM placements")
SQL_VIEWS["placed_turns"] = f"SELECT *, {matrix()} FROM placed_rotations"
SQL_VIEWS["posed"] = f"""
    SELECT sample_id, anchor_mesh AS mesh_id, point_id, {", ".join(f"{e} + c{a} + n.mid{a} AS {a}" for e, a in zip(turned([f"(p.{a} - o.mid{a}) * scale" for a in "xyz"]), "xyz"))}
    FROM placed_turns t JOIN points p ON p.mesh_id = t.mesh_id JOIN mesh_bounds o ON o.mesh_id = t.mesh_id JOIN mesh_bounds n ON n.mesh_id = t.anchor_mesh"""
SQL_VIEWS["posed_after"] = """
    SELECT sample_id, mesh_id, point_id, mx + cos(radians(turn)) * (x - mx) + sin(radians(turn)) * (z - mz) + slide AS x, y - fall AS y,
       mz - sin(radians(turn)) * (x - mx) + cos(radians(turn)) * (z - mz) AS z
    FROM posed JOIN (SELECT sample_id, avg(x) AS mx, avg(z) AS mz FROM posed GROUP BY sample_id) USING (sample_id) JOIN (SELECT sample_id, turn, slide, fall FROM placements) USING (sample_id)"""


def posed(t):
    """Points of every placed mesh in the frame of its anchor."""
    return PO.place_bodies(t.points, t.placements, M.bounds(t.triangles))


def scene(t):
    """The bodies with what their tasks read: points by mesh and fields by anchor."""
    phi, headers = V.distance_field(t.triangles, FIELD_RESOLUTION)
    return B.Scene(t.points, t.placements, M.bounds(t.triangles), phi, cut(headers))


def posed_after(t, before):
    """The bodies after a turn about the upright axis through their centroid, a slide and a fall."""
    centre = before.groupBy("sample_id").agg(*[F.avg(a).alias(f"m{a}") for a in "xyz"])
    rows = before.join(centre, "sample_id").join(t.placements.select("sample_id", "turn", "slide", "fall"), "sample_id")
    q = G.from_euler(F.lit(0.0), F.col("turn"), F.lit(0.0))
    placed = G.add(G.add(G.rotate(q, G.sub(G.vec(""), G.vec("m"))), G.vec("m")), (F.col("slide"), -F.col("fall"), F.lit(0.0)))
    return rows.select("sample_id", "mesh_id", "point_id", *[c.alias(a) for c, a in zip(placed, "xyz")])


def add_graded(name: str, source: str) -> None:
    """View ``<name>``: field value and unit gradient of ``source(mesh_id, sample_id, point_id, x, y, z)``."""
    SQL_VIEWS[f"{name}_probes"] = f"""
        SELECT p.mesh_id, sample_id, point_id, tag, x + dx * cell / 2 AS x, y + dy * cell / 2 AS y, z + dz * cell / 2 AS z FROM {source} p JOIN sdf_head USING (mesh_id),
          (VALUES ('o', 0, 0, 0), ('x1', 1, 0, 0), ('x2', -1, 0, 0), ('y1', 0, 1, 0), ('y2', 0, -1, 0), ('z1', 0, 0, 1), ('z2', 0, 0, -1)) d(tag, dx, dy, dz)"""
    SQL_VIEWS[f"{name}_probed"] = sampled_sql(f"{name}_probes", "sample_id, point_id, tag")
    SQL_VIEWS[name] = f"""
        SELECT mesh_id, sample_id, point_id, phi, CASE WHEN n > 1e-12 THEN gx / n ELSE 0 END AS gradx, CASE WHEN n > 1e-12 THEN gy / n ELSE 1 END AS grady,
           CASE WHEN n > 1e-12 THEN gz / n ELSE 0 END AS gradz FROM (SELECT *, sqrt(gx * gx + gy * gy + gz * gz) AS n FROM (
             SELECT mesh_id, sample_id, point_id, max(phi) FILTER (tag = 'o') AS phi, max(phi) FILTER (tag = 'x1') - max(phi) FILTER (tag = 'x2') AS gx,
               max(phi) FILTER (tag = 'y1') - max(phi) FILTER (tag = 'y2') AS gy, max(phi) FILTER (tag = 'z1') - max(phi) FILTER (tag = 'z2') AS gz
             FROM {name}_probed GROUP BY mesh_id, sample_id, point_id))"""


add_graded("graded", "posed")


@query("g9_field_samples", f"SELECT sample_id, point_id, {r6('phi')} AS phi, {', '.join(f'{r6(f'grad{a}')} AS grad{a}' for a in 'xyz')} FROM graded")
def _(t):
    return B.field_samples(scene(t), 6)


@query("v10_toward_anchor", f"""
    SELECT sample_id, mesh_id, point_id, {", ".join(f"{r6(f'-grad{a}')} AS dir{a}" for a in "xyz")} FROM graded
    QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY round(phi, 9), point_id) = 1""")
def _(t):
    found = B.toward_anchor(scene(t))
    return found.select("sample_id", "mesh_id", "point_id", *[T.fixed(F.col(f"dir{a}")).alias(f"dir{a}") for a in "xyz"])


# ---- nearest surface and contact --------------------------------------------------------

def add_nearest(name: str, source: str, cells: float) -> None:
    """View ``<name>``: every pair of point and anchor triangle, the nearest within ``cells`` cells of the anchor's grid."""
    pairs = f"SELECT p.mesh_id, p.sample_id, p.point_id, p.x, p.y, p.z, cell, t.tri_id, {', '.join(f't."{c}"' for c in M.COORDS)} FROM {source} p JOIN triangles t ON t.mesh_id = p.mesh_id JOIN sdf_head h ON h.mesh_id = p.mesh_id"
    SQL_VIEWS[name] = f"""
        WITH {nearest_sql(pairs)},
          b AS (SELECT *, row_number() OVER (PARTITION BY sample_id, point_id ORDER BY dist, tri_id) AS rn FROM near WHERE dist <= {cells} * cell)
        SELECT p.mesh_id, p.sample_id, p.point_id, p.x, p.y, p.z, b.tri_id, b.dist, b.wx, b.wy, b.wz
        FROM {source} p LEFT JOIN b ON b.sample_id = p.sample_id AND b.point_id = p.point_id AND rn = 1"""


add_nearest("nearest", "posed", X.GAP_CELLS)


@query("j14_nearest_surface", f"""
    SELECT sample_id, point_id, coalesce(tri_id, -1) AS tri_id, {r6('coalesce(dist, -1)')} AS dist, {r6('coalesce(wx, 9)')} AS wx FROM nearest""")
def _(t):
    headers = V.grid_headers(t.triangles, FIELD_RESOLUTION, V.FIELD_PAD)
    found = X.nearest_surface(cut(posed(t)), t.triangles, headers, X.GAP_CELLS, KEYS)
    return found.select("sample_id", "point_id", F.coalesce("tri_id", F.lit(-1)).alias("tri_id"), T.fixed(F.coalesce("dist", F.lit(-1.0))).alias("dist"),
                        T.fixed(F.coalesce("wx", F.lit(9.0))).alias("wx"))


def gaps_sql(near: str, graded: str) -> str:
    """Field minimum, exact distance of points less than six cells away by the field, and gap per sample."""
    return f"""
        SELECT sample_id, mesh_id, min(phi) AS field_min, min(dist) FILTER (phi < {X.GAP_CELLS} * cell) AS exact,
          CASE WHEN min(phi) < 0 THEN min(phi) ELSE coalesce(min(dist) FILTER (phi < {X.GAP_CELLS} * cell), min(phi)) END AS gap
        FROM {near} JOIN {graded} USING (mesh_id, sample_id, point_id) JOIN (SELECT mesh_id, cell FROM sdf_head) USING (mesh_id) GROUP BY sample_id, mesh_id"""


SQL_VIEWS["gaps"] = gaps_sql("nearest", "graded")


@query("a20_minimum_gap", f"SELECT sample_id, mesh_id, {r6('field_min')} AS field_min, {r6('exact')} AS exact, {r6('gap')} AS gap FROM gaps")
def _(t):
    found = X.body_gap(X.measured(posed(t), t.triangles, *field(t), KEYS), KEYS)
    return found.select("sample_id", "mesh_id", *[T.fixed(F.col(c)).alias(c) for c in ("field_min", "exact", "gap")])


SQL_VIEWS["moves"] = """
    SELECT mesh_id, avg(pitch) * mesh_id / 2 AS degrees, avg(cx) * 0.3::DOUBLE AS sx, -0.4::DOUBLE * mesh_id * avg(scale) AS sy FROM poses GROUP BY mesh_id"""
SQL_VIEWS["after"] = """
    SELECT b.mesh_id, point_id, mx + cos(radians(degrees)) * dx + sin(radians(degrees)) * dz + sx AS x, my + dy + sy AS y,
       mz - sin(radians(degrees)) * dx + cos(radians(degrees)) * dz AS z, degrees FROM bodies b JOIN moves USING (mesh_id)"""


def after(t):
    """The point sets after a turn about +Y and a shift derived from each mesh's poses."""
    moves = t.poses.groupBy("mesh_id").agg(
        (F.avg("pitch") * F.col("mesh_id") / 2).alias("degrees"), (F.avg("cx") * 0.3).alias("sx"),
        (F.avg("scale") * F.col("mesh_id") * -0.4).alias("sy"))
    centre = t.points.groupBy("mesh_id").agg(*[F.avg(a).alias(f"m{a}") for a in "xyz"])
    rows = t.points.join(centre, "mesh_id").join(moves, "mesh_id")
    q = G.from_euler(F.lit(0.0), F.col("degrees"), F.lit(0.0))
    turned = G.rotate(q, G.sub(G.vec(""), G.vec("m")))
    placed = G.add(G.add(turned, G.vec("m")), (F.col("sx"), F.col("sy"), F.lit(0.0)))
    return rows.select("mesh_id", "point_id", *[c.alias(a) for c, a in zip(placed, "xyz")], "degrees")


SQL_VIEWS["after_phi"] = sampled_sql("posed_after", "sample_id, point_id")
add_nearest("after_nearest", "posed_after", X.GAP_CELLS)
SQL_VIEWS["after_gaps"] = gaps_sql("after_nearest", "after_phi")
SQL_VIEWS["contact_base"] = """
    SELECT g.sample_id, g.mesh_id, g.gap / l AS gap, greatest(0, -g.field_min) / l AS depth, radius / l AS radius, fall / l AS drop_, a.gap / l AS after_,
      drift / l AS drift, travel / l AS travel, turn, a.field_min < h.cell AS near
    FROM gaps g JOIN after_gaps a USING (sample_id) JOIN placements p USING (sample_id)
    JOIN (SELECT mesh_id, cell, greatest(sizex, sizey, sizez) AS l FROM sdf_head) h ON h.mesh_id = g.mesh_id
    JOIN (SELECT sample_id, max(sqrt((x - mx) * (x - mx) + (y - my) * (y - my) + (z - mz) * (z - mz))) AS radius FROM posed JOIN (
      SELECT sample_id, avg(x) AS mx, avg(y) AS my, avg(z) AS mz FROM posed GROUP BY sample_id) USING (sample_id) GROUP BY sample_id) r USING (sample_id)
    JOIN (SELECT b.sample_id, sqrt((e.x - b.x) * (e.x - b.x) + (e.z - b.z) * (e.z - b.z)) AS drift FROM (
      SELECT * FROM posed QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY y, point_id) = 1) b JOIN posed_after e USING (sample_id, point_id)) d USING (sample_id)
    JOIN (SELECT sample_id, sqrt(slide * slide + fall * fall) AS travel FROM placements) m USING (sample_id)"""
SQL_VIEWS["contact_qc"] = """
    SELECT *, gap < -radius AS deep, gap >= -radius AND (drift > greatest(0.25, 1.5 * radius) OR turn > 60) AS drifted,
      drop_ > greatest(0.35, 3 * radius) AND NOT near AS far FROM contact_base"""


@query("v9_contact_qc", f"""
    SELECT sample_id, mesh_id, {", ".join(f"{r6(c)} AS {c}" for c in ("gap", "depth", "radius", "drift"))}, {r6('drop_')} AS dropped,
      {r6('CASE WHEN deep OR drifted THEN 0 ELSE travel END')} AS moved, {r6('CASE WHEN deep OR drifted THEN 0 ELSE turn END')} AS rotated,
      {r6('CASE WHEN deep OR drifted THEN gap ELSE after_ END')} AS gap_after,
      CASE WHEN deep THEN 'deep_penetration' WHEN drifted THEN 'drifted' WHEN far THEN 'dropped_far' ELSE '' END AS flags FROM contact_qc""")
def _(t):
    before = cut(posed(t))
    turned_by = t.placements.select("sample_id", F.col("anchor_mesh").alias("mesh_id"), F.col("turn").alias("rotated"))
    found = X.contact_table(before, cut(posed_after(t, before)), t.triangles, *field(t), turned_by, KEYS)
    lengths = {"gap": "gap", "depth": "depth", "radius": "radius", "drift": "drift", "drop": "dropped", "moved": "moved", "rotated": "rotated", "gap_after": "gap_after"}
    return found.select("sample_id", "mesh_id", *[T.fixed(F.col(c)).alias(name) for c, name in lengths.items()], F.array_join("flags", ";").alias("flags"))


_GROUND = -0.6
_NLEN = "sqrt(({x})*({x}) + ({y})*({y}) + ({z})*({z}))"
_N = {"x": '(t."by"-t.ay)*(t.cz-t.az)-(t.bz-t.az)*(t.cy-t.ay)', "y": "(t.bz-t.az)*(t.cx-t.ax)-(t.bx-t.ax)*(t.cz-t.az)", "z": '(t.bx-t.ax)*(t.cy-t.ay)-(t."by"-t.ay)*(t.cx-t.ax)'}
SQL_VIEWS["directed"] = f"""
    SELECT n.sample_id, dist AS g FROM nearest n JOIN graded USING (mesh_id, sample_id, point_id) JOIN triangles t ON t.tri_id = n.tri_id AND t.mesh_id = n.mesh_id
    JOIN sdf_head h ON h.mesh_id = n.mesh_id WHERE phi <= {X.BAND_CELLS} * h.cell AND dist <= {X.BAND_CELLS} * h.cell
    AND -grady <= -0.5 AND CASE WHEN dist < 0.001 THEN {_NLEN.format(**_N)} > 1e-12 AND abs({_N['y']}) >= 0.8 * {_NLEN.format(**_N)} ELSE abs(n.wy - n.y) >= 0.5 * dist END"""


@query("v11_directional_gap", f"""
    SELECT p.sample_id, p.mesh_id, {r6("coalesce(any_value(d.g), -1)")} AS gap, {r6(f"least(coalesce(any_value(d.g), 1e9), min(p.y) - {_GROUND})")} AS with_ground
    FROM posed p LEFT JOIN (SELECT sample_id, min(g) AS g FROM directed GROUP BY sample_id) d USING (sample_id) GROUP BY p.sample_id, p.mesh_id""")
def _(t):
    rows = cut(X.measured(posed(t), t.triangles, *field(t), KEYS))
    down = (0.0, -1.0, 0.0)
    free = X.directional_gap(rows, t.triangles, down, keys=KEYS)
    floor = X.directional_gap(rows, t.triangles, down, F.lit(_GROUND), KEYS).withColumnRenamed("gap", "with_ground")
    return free.join(floor, ["sample_id", "mesh_id"]).select(
        "sample_id", "mesh_id", T.fixed(F.coalesce("gap", F.lit(-1.0))).alias("gap"), T.fixed(F.col("with_ground")).alias("with_ground"))


SQL_VIEWS["shifted"] = "SELECT mesh_id, sample_id, point_id, n, x, y - n * 0.1::DOUBLE AS y, z FROM posed, range(4) r(n)"
SQL_VIEWS["shifted_phi"] = sampled_sql("shifted", "sample_id, point_id, n")


@query("v13_lowest_field", f"""
    SELECT sample_id, mesh_id, n * 0.1::DOUBLE AS t, {r6(f'min(least(phi, y - {_GROUND}))')} AS least FROM shifted_phi GROUP BY sample_id, mesh_id, n""")
def _(t):
    found = B.lowest_field(scene(t), [n * 0.1 for n in range(4)], _GROUND)
    return found.select("sample_id", "mesh_id", (F.round(F.col("t") * 10) * 0.1).alias("t"), T.fixed(F.col("least")).alias("least"))


@query("v14_displacement", f"""
    SELECT mesh_id, {r6('avg(sqrt((a.x-p.x)*(a.x-p.x)+(a.y-p.y)*(a.y-p.y)+(a.z-p.z)*(a.z-p.z)))')} AS moved, {r6('min(a.y)')} AS lowest
    FROM points p JOIN after a USING (mesh_id, point_id) GROUP BY mesh_id""")
def _(t):
    return X.displacement(t.points, after(t)).select("mesh_id", T.fixed(F.col("moved")).alias("moved"), T.fixed(F.col("lowest")).alias("lowest"))


@query("v15_support_drift", f"""
    SELECT p.mesh_id, p.point_id, {r6('sqrt((a.x-p.x)*(a.x-p.x)+(a.z-p.z)*(a.z-p.z))')} AS drift,
       sqrt((a.x-p.x)*(a.x-p.x)+(a.z-p.z)*(a.z-p.z)) > 0.25 OR degrees > 60 AS drifted
    FROM (SELECT * FROM points QUALIFY row_number() OVER (PARTITION BY mesh_id ORDER BY y, point_id) = 1) p JOIN after a USING (mesh_id, point_id)""")
def _(t):
    end = after(t)
    found = X.support_drift(t.points, end).join(end.select("mesh_id", "point_id", "degrees"), ["mesh_id", "point_id"])
    verdict = (F.col("drift") > 0.25) | (F.col("degrees") > X.ROTATION_CAP)
    return found.select("mesh_id", "point_id", T.fixed(F.col("drift")).alias("drift"), verdict.alias("drifted"))


# ---- lattice ----------------------------------------------------------------------------

SQL_VIEWS["lat_head"] = headers_sql("mesh_bounds", FIELD_RESOLUTION, 1)
SQL_VIEWS["nodes"] = surface_sql("triangles", "lat_head")
_LINKS = ", ".join(f"('{kind}', {o[0]}, {o[1]}, {o[2]})" for kind, o in V.LINKS)
SQL_VIEWS["node_links"] = f"""
    SELECT a.mesh_id, a.x, a.y, a.z, b.x AS x2, b.y AS y2, b.z AS z2, kind, sqrt(ox * ox + oy * oy + oz * oz) * cell AS rest
    FROM nodes a, (VALUES {_LINKS}) l(kind, ox, oy, oz), nodes b, lat_head h
    WHERE b.mesh_id = a.mesh_id AND b.x = a.x + ox AND b.y = a.y + oy AND b.z = a.z + oz AND h.mesh_id = a.mesh_id"""


@query("j15_neighbour_links", f"SELECT mesh_id, x, y, z, x2, y2, z2, kind, {r6('rest')} AS rest FROM node_links")
def _(t):
    return V.links(*V.lattice(t.triangles, FIELD_RESOLUTION)).withColumn("rest", T.fixed(F.col("rest")))


@query("v12_lattice", f"""
    SELECT mesh_id, kind, count(*) AS links, {r6('sum(rest)')} AS length, (SELECT count(*) FROM nodes n WHERE n.mesh_id = k.mesh_id) AS nodes
    FROM node_links k GROUP BY mesh_id, kind""")
def _(t):
    nodes, headers = V.lattice(t.triangles, FIELD_RESOLUTION)
    count = nodes.groupBy("mesh_id").agg(F.count(F.lit(1)).alias("nodes"))
    found = V.links(nodes, headers).groupBy("mesh_id", "kind").agg(F.count(F.lit(1)).alias("links"), T.fixed(F.sum("rest")).alias("length"))
    return found.join(count, "mesh_id")


SQL_VIEWS["moved_nodes"] = "SELECT *, " + ", ".join(
    f"g{a} + ({a} + 0.5::DOUBLE) * cell + 0.01::DOUBLE * {a} AS p{a}" for a in "xyz") + " FROM nodes JOIN lat_head USING (mesh_id)"
_EIGHT = ", ".join(f"({n & 1}, {n >> 1 & 1}, {n >> 2 & 1})" for n in range(8))
_W = " * ".join(f"(CASE WHEN o{a} = 1 THEN u{a} - floor(u{a}) ELSE 1 - (u{a} - floor(u{a})) END)" for a in "xyz")


@query("g14_embedded_points", f"""
    WITH b AS (SELECT p.*, nx, ny, nz, {", ".join(f"({a} - g{a}) / cell - 0.5 AS u{a}" for a in "xyz")} FROM points p JOIN lat_head USING (mesh_id)),
      c AS (SELECT point_id, sum(w) AS total, {", ".join(f"sum(w * p{a}) AS s{a}" for a in "xyz")} FROM (
              SELECT b.point_id, {_W} AS w, px, py, pz FROM b, (VALUES {_EIGHT}) o(ox, oy, oz), moved_nodes m
              WHERE m.mesh_id = b.mesh_id AND m.x = floor(ux) + ox AND m.y = floor(uy) + oy AND m.z = floor(uz) + oz) WHERE w > 0 GROUP BY point_id HAVING sum(w) > 1e-9),
      r AS (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY greatest(abs(dx), abs(dy), abs(dz)), dy, dz, dx) AS rn FROM (
              SELECT b.point_id, dx, dy, dz, px, py, pz FROM b, range(-3, 4) i(dx), range(-3, 4) j(dy), range(-3, 4) k(dz), moved_nodes m
              WHERE b.point_id NOT IN (SELECT point_id FROM c) AND m.mesh_id = b.mesh_id AND {" AND ".join(f"m.{a} = least(b.n{a} - 1, greatest(0, least(b.n{a} - 1, greatest(0, floor(u{a} + 0.5))) + d{a}))" for a in "xyz")}))
    SELECT p.point_id, {", ".join(f"{r6(f'coalesce(s{a} / total, r.p{a}, p.{a})')} AS e{a}" for a in "xyz")},
       CASE WHEN total IS NOT NULL THEN 'lattice' WHEN r.point_id IS NOT NULL THEN 'nearest' ELSE 'unmoved' END AS via
    FROM points p LEFT JOIN c ON c.point_id = p.point_id LEFT JOIN r ON r.point_id = p.point_id AND r.rn = 1""")
def _(t):
    nodes, headers = V.lattice(t.triangles, FIELD_RESOLUTION)
    placed = nodes.join(headers, "mesh_id").select(
        *V.CELL, *[(F.col(f"g{a}") + (F.col(a) + 0.5) * F.col("cell") + 0.01 * F.col(a)).alias(f"p{a}") for a in "xyz"])
    found = X.embed_points(t.points, placed, headers)
    return found.select("point_id", *[T.fixed(F.col(f"e{a}")).alias(f"e{a}") for a in "xyz"], "via")
