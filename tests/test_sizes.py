"""Plans and rounds that must hold on tables far larger than those of the other tests."""

from functools import reduce

from pyspark.sql import functions as F

from plinth.catalog.registry import REGISTRY
from plinth.catalog.tables import BOX_RESOLUTION, Tables
from plinth.operators import meshes as M
from plinth.operators import proximity as X
from plinth.operators import voxels as V
from tests.conftest import SF_DIR


def copies(spark, tmp_path, times, **keys):
    """The smallest tables, those of ``keys`` repeated ``times`` with shifted key columns."""
    for name in "customer supplier part orders lineitem events documents embeddings pages labels conversations".split():
        rows = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        if name in keys:
            rows = reduce(lambda a, b: a.unionByName(b), [
                rows.withColumns({c: F.col(c) + n * 1_000_000 for c in keys[name]}) for n in range(times)])
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def broadcasts(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if "BroadcastHashJoin" in line]


def test_scene_rows_never_broadcast_parts_or_customers(spark):
    """tables that grow with the input looked small enough to the planner to pass through the driver."""
    for name in ("j18_positional_assignment", "w1_deal_plan"):
        joined = broadcasts(REGISTRY[name].run(spark, SF_DIR))
        assert not [line for line in joined if "partkey" in line or "custkey" in line], joined


def test_boxes_of_a_kind_share_their_grid(spark, tmp_path):
    """grids are made once per kind of box, and give what each box's own grid would."""
    t = Tables(spark, copies(spark, tmp_path, 3, part=["p_partkey"]))
    assert t.kind_boxes.count() < t.boxes.count()
    fine = V.subdivide(V.grid_headers(t.boxes, BOX_RESOLUTION), V.SUBDIVISION)
    own = V.surface_cells(t.boxes, fine)
    kind_fine = V.subdivide(V.grid_headers(t.kind_boxes, BOX_RESOLUTION), V.SUBDIVISION)
    shared = t.of_boxes(V.surface_cells(t.kind_boxes, kind_fine))
    assert own.count() == shared.count() and own.exceptAll(shared).isEmpty()
    assert not [line for line in broadcasts(shared) if "kind" in line and "LeftOuter" not in line]  # only hot keys may be


def test_probes_of_a_point_stay_in_its_task(spark):
    """seven rows per point used to be shuffled and grouped again."""
    cells = [(1, x, y, z, float(x - 4)) for x in range(9) for y in range(9) for z in range(9)]
    phi = spark.createDataFrame(cells, "mesh_id long, x int, y int, z int, phi double")
    headers = spark.createDataFrame([(1, 1.0, 9, 9, 9, 0.0, 0.0, 0.0)], "mesh_id long, cell double, nx int, ny int, nz int, gx double, gy double, gz double")
    points = spark.range(30_000).selectExpr("1L AS mesh_id", "id AS point_id", "1 + id % 7 + 0.25D AS x", "4.0D AS y", "4.0D AS z")
    found = X.field_gradient(points, X.field_bricks(phi, headers), headers)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "point_id" in line]
    wrong = found.where("abs(phi - (x - 4.5)) > 1e-9 OR abs(gradx - 1) > 1e-9 OR abs(grady) > 1e-9")
    assert found.count() == 30_000 and wrong.isEmpty()


def test_shifts_of_all_bodies_need_no_join(spark):
    """the shifts of every body were joined with all of its points."""
    joins = broadcasts(REGISTRY["v13_lowest_field"].run(spark, SF_DIR))
    plan = REGISTRY["v13_lowest_field"].run(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert joins and not [line for line in plan.split("\n") if "Join [mesh_id" in line and "sample_id" in line]


def test_posed_boxes_hold_only_what_they_fold(spark):
    """the last task joined poses, made again from order lines, to the folded boxes; a grouping held a mesh's tetrahedra per vertex."""
    def lines(df):
        return df._jdf.queryExecution().executedPlan().toString().split("\n")

    posed = lines(REGISTRY["a10_posed_sizes"].run(spark, SF_DIR))
    assert not [line for line in posed if "SortAggregate" in line or "Join [sample_id" in line]
    outer = M.outer_vertices(Tables(spark, SF_DIR).triangles)
    assert not [line for line in lines(outer) if "Aggregate" in line and "solids" in line]
