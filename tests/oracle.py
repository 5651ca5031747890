"""Run a registered query on Spark and on DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def make_spark(cores: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("plinth")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "16g")
        .config("spark.sql.adaptive.enabled", "true").config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def make_duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, query, sf_dir) -> tuple[str, str, float, float]:
    start = time.time()
    df = query.run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if not query.sql:
        return ("rows" if rows else "EMPTY"), f"{len(rows)} rows", took, 0.0
    start = time.time()
    got = con.execute(query.sql)
    columns = [d[0] for d in got.description]
    expected = got.fetchall()
    duck = time.time() - start
    if sorted(columns) != sorted(df.columns):
        return "COLUMNS", f"{df.columns} vs {columns}", took, duck
    a, b = normal(rows, df.columns), normal(expected, columns)
    if len(a) != len(b):
        return "COUNT", f"{len(a)} vs {len(b)}: {a[:2]} vs {b[:2]}", took, duck
    bad = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
    if bad:
        return "VALUES", f"{len(bad)} of {len(a)} differ; {sorted(df.columns)}: {bad[0][0]} vs {bad[0][1]}", took, duck
    return ("ok" if a else "EMPTY"), f"{len(a)} rows", took, duck
