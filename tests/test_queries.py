"""Every registered query against DuckDB on the smallest tables."""

import pytest

from firngrid.plans import queries as q
from tests.oracles import connection, of_duckdb, of_spark


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_against_sql(spark, data, name):
    assert of_spark(q.QUERIES[name](spark, data)) == of_duckdb(connection(data), q.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - set(q.ORACLE_SQL)))
def test_runs(spark, data, name):
    assert q.QUERIES[name](spark, data).columns


def test_entry(spark, data):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
