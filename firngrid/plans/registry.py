"""Registered queries: a Spark plan over the test tables, and DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from firngrid.plans.fixtures import VIEW_SQL, Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def oracle(views: str, body: str) -> str:
    """``body`` after the views it names; it is a select, or further views and a select."""
    heads: list[str] = []

    def need(name: str) -> None:
        uses, text = VIEW_SQL[name]
        for other in uses:
            need(other)
        if (head := f"fx_{name} as ({text})") not in heads:
            heads.append(head)

    for name in views.split():
        need(name)
    body = body.strip()
    if not heads:
        return body if body.lower().startswith("select") else f"with recursive {body}"
    join = "\n" if body.lower().startswith("select") else ",\n"
    return "with recursive " + ",\n".join(heads) + join + body


def query(name: str, views: str = "", sql: str | None = None):
    """Register a function of Fixtures under ``name``, with the SQL of the same result."""

    def add(fn: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Fixtures(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[name] = oracle(views, sql)
        return fn

    return add
