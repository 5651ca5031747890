"""Registered queries against DuckDB at the smallest scale (all of them with PLINTH_ALL=1)."""

import os

import pytest

from plinth.catalog import REGISTRY
from tests.conftest import SF_DIR
from tests.oracle import compare

QUICK = """p3_slug p7_category_members p8_scene_validator p21_staging g2_dates j4_not_offered j10_image_fallback j12_as_of
a2_pool_summary a4_shortfall a19_scale_audit w2_deck_offers w10_settled w11_grace_verdicts g7_resolve_pose a10_posed_sizes
v5_blocks v7_signed_distance j14_nearest_surface s9_parsed_logs k4_publish r3_sessions""".split()
NAMES = list(REGISTRY) if os.environ.get("PLINTH_ALL") else QUICK


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    verdict, note, _took, _duck = compare(spark, duck, REGISTRY[name], SF_DIR)
    assert verdict in ("ok", "rows"), note


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 12
