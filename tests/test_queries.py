"""Every registered query against its SQL on the smallest tables, and the plans of the big ones."""

import duckdb
import pytest
from conftest import SMALL

from __spark_entry__ import entry
from check import TABLES, compare
from loadweir.session import shared_dir
from oracle import ORACLE
from queries import QUERIES

# The queries of the optional subpackage have tests of their own.
RUNS, SQLS = dict(QUERIES), dict(ORACLE)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(SQLS) == set(RUNS)


@pytest.mark.parametrize("name", sorted(RUNS))
def test_agrees_with_sql(spark, db, name):
    verdict = compare(spark, db, name, RUNS[name], SQLS[name], SMALL)
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "_extracted_at" in df.columns


def plan_of(spark, name):
    return RUNS[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("src_file_scan", "GreaterThan(o_totalprice,250000.0)"),
        ("src_param_filter", "EqualTo(o_orderpriority,1-URGENT)"),
        ("incremental_filter", "GreaterThan(o_orderdate,1998-06-30T00:00)"),
        ("backfill_window", "LessThan(ts,2024-01-20T00:00)"),
        ("src_parent_feed", "EqualTo(c_mktsegment,BUILDING)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan_of(spark, name)


@pytest.mark.parametrize("name", sorted(RUNS))
def test_no_cross_join_and_no_python_on_the_row_path(spark, name):
    if name.startswith(("stream_", "write_", "load_", "retention_", "compact", "append_once_t")):
        pytest.skip("reads back what it wrote")
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert base is None or shared_dir(spark, "x").startswith(base.rstrip("/"))
