"""Every registered query against its SQL in DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_oracles import rows_of

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    ours = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert ours
        return
    result = db.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, ours) == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 10


def test_no_cross_joins(spark):
    for name in ("bm25", "boolean", "batch_search", "more_like_this", "agg_nested", "permission_filter", "log_search"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["range_exclusive"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,100000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
