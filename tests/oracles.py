"""Rows of a Spark result and of DuckDB SQL in a form that can be compared."""

from __future__ import annotations

from decimal import Decimal

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with a view for each table of a folder."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _plain(x):
    if x is None or x != x:
        return "null"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float, Decimal)):
        x = float(x) if isinstance(x, Decimal) else x
        return str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(round(x, 6))
    return str(x)


def rows(columns, values) -> tuple[list[str], list[tuple]]:
    """Columns by name, and sorted rows of plain values."""
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(_plain(v[k]) for k in order) for v in values)


def of_spark(df):
    """The rows of a DataFrame."""
    return rows(df.columns, df.collect())


def of_duckdb(con, sql: str):
    """The rows of a query."""
    found = con.execute(sql)
    return rows([c[0] for c in found.description], found.fetchall())
