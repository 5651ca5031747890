"""Compare registered queries with their SQL: ``python check.py [sf] [name part ...]``."""

from __future__ import annotations

import sys
import traceback

from plinth.catalog import REGISTRY
from tests.oracle import compare, make_duck, make_spark


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    parts = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = make_spark(), make_duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    failures = 0
    for name, query in REGISTRY.items():
        if parts and not any(name.startswith(p) for p in parts):
            continue
        try:
            verdict, note, took, duck = compare(spark, con, query, sf_dir)
        except Exception as failure:  # noqa: BLE001
            verdict, note, took, duck = "ERROR", " ".join(str(failure).split())[:400], 0.0, 0.0
            if "-v" in parts:
                traceback.print_exc()
        failures += verdict not in ("ok", "rows")
        print(f"{verdict:8} {name:34} {took:6.2f}s duck {duck:5.2f}s  {note if verdict != 'ok' else note}"[:600], flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(min(1, main()))
