"""Every query of the registry against its SQL, run by DuckDB on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from claimsift.plans import registry
from oracle import queries as oracle_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}
QUERIES, SQL = registry.queries(), oracle_queries.all_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def in_order(rows):
    return sorted(rows, key=lambda row: [(value is None, value if value is not None else 0) for value in row])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.keys() <= entry_points.queries().keys() and SQL.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = duck.execute(SQL[name])
    types = {column[0]: str(column[1]) for column in result.description}
    names = [column[0] for column in result.description]
    expected = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    assert sorted(names) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert in_order([tuple(r) for r in df.select(*columns).collect()]) == in_order(expected)
    assert expected


def test_entry(spark):
    page = entry_points.entry(spark)
    assert page.count() == 50
