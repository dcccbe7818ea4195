"""Queries of the subpackage against their SQL, run by DuckDB on the same tables."""

import os

import duckdb
import pytest

from claimsift.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = queries.queries(), queries.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert expected


def test_all_operators_and_the_pipeline_are_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)} | {"pipeline"}


def test_license_scan_of_rows_without_an_id(spark, tmp_path):
    rows = [(None, "Released under the MIT License.", "src1"), (None, "words", "src1"), (None, None, None),
            (1001, "Released under the MIT License.", "src1"), (1002, "words", "src1"), (7, "words", "src1")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [(r["doc_id"], r["license"], r["origin"]) for r in QUERIES["op2_license_scan"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted([
        (None, "MIT", "file"), (None, "MIT", "inherited"), (None, None, "none"), (1001, "MIT", "file"),
        (1002, "MIT", "inherited"), (7, None, "none")], key=repr)
