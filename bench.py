"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``: one JSON line, warm wall-clock seconds.

``duckdb`` holds the seconds that DuckDB takes for the same query as SQL on the same files and cores.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

from plinth.catalog import REGISTRY
from tests.oracle import make_duck, make_spark

HEADLINE = """a2_pool_summary a4_shortfall a19_scale_audit j12_as_of w1_deal_plan w2_deck_offers w10_settled p8_scene_validator
w4_first_by_one_key g7_resolve_pose a10_posed_sizes v2_surface_cells v3_filled_cells v5_blocks v7_signed_distance
j14_nearest_surface s9_parsed_logs k4_publish""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = make_spark(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    seconds, duck, con = {}, {}, make_duck(sf_dir)
    con.execute(f"SET threads = {int(os.environ.get('BENCH_CPUS', '8'))}")
    for name in HEADLINE:
        times = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "2"))):
            start = time.time()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.time() - start)
        seconds[name] = round(min(times), 3)
        if REGISTRY[name].sql:
            start = time.time()
            with contextlib.suppress(Exception):
                con.execute(REGISTRY[name].sql).fetchall()
                duck[name] = round(time.time() - start, 3)
        print(name, seconds[name], duck.get(name), file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    with contextlib.suppress(Exception):
        spark.stop()
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "duckdb": duck, "sf": os.path.basename(sf_dir)}))


if __name__ == "__main__":
    main()
