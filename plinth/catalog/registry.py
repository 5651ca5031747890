"""Registered queries: a Spark function plus, where SQL can say it, the same query as SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plinth.catalog.sqlviews import SQL_VIEWS
from plinth.catalog.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def _needed(body: str) -> list[str]:
    """View names used by ``body``, dependencies first (SQL_VIEWS is in dependency order)."""
    used: set[str] = set()

    def visit(text: str) -> None:
        for name in SQL_VIEWS:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                visit(SQL_VIEWS[name])

    visit(body)
    return [name for name in SQL_VIEWS if name in used]


def with_views(body: str) -> str:
    """``body`` with the view definitions it uses put in front as CTEs."""
    body = body.strip()
    views = [f"{name} AS ({SQL_VIEWS[name].strip()})" for name in _needed(body)]
    head = re.match(r"WITH\s+(RECURSIVE\s+)?", body)
    if head:
        views.append(body[head.end():])
        return "WITH RECURSIVE " + ",\n".join(views)
    if not views:
        return body
    return "WITH RECURSIVE " + ",\n".join(views) + "\n" + body


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        run = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        REGISTRY[name] = Query(name, run, with_views(sql) if sql else None)
        return fn

    return add
