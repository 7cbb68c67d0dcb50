"""The registered queries: contract, plans, and results against DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from catalogflow.plans import all_oracles, all_queries
from tools.check_queries import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
# the training-data folder tests its own queries
QUERIES, SQL = all_queries(), all_oracles()
# global aggregates and scalar lookups of one row; nothing else meets in one task
ONE_ROW = {
    "recent_days_metric", "replace_issue_report", "issue_rollup", "issue_index", "issue_index_pages", "catalog_audit",
    "best_match_in_group", "ingest_in_press_changes",
}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert set(QUERIES) - set(SQL) <= {"exclude_issued_fuzzy"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = con.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert len(set(c.lower() for c in names)) == len(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


def plan_of(spark, df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def test_plans_at_any_size(spark, no_broadcast):
    """With broadcasts off, as for large tables: no all-pairs joins, no row-wise Python."""
    for name, query in QUERIES.items():
        if name.startswith("stream_"):
            continue
        plan = plan_of(spark, query(spark, FOLDER))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "Broadcast"):
            assert bad not in plan, (name, bad)
        if name not in ONE_ROW:
            assert "Exchange SinglePartition" not in plan, name


def test_plan_shapes(spark):
    top = plan_of(spark, QUERIES["usage_top_unique"](spark, FOLDER))
    assert top.count("TakeOrderedAndProject") == 3 and "WindowGroupLimit" in top
    assert "WindowGroupLimit" in plan_of(spark, QUERIES["daily_pick"](spark, FOLDER))
    recent = plan_of(spark, QUERIES["recent_by_access"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate,2001-02-15T12:00)" in recent
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz>" in recent


def test_entry_is_the_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["l_partkey", "downloads", "l_orderkey", "p_name", "authors", "abstract"] and df.count() > 0


def test_recent_view_holds_the_whole_batch(spark):
    """Orders in progress are in the batch too: no row of a recent issue is missing."""
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").filter("o_orderdate >= '2001-03-01' and o_orderstatus = 'P'")
    waiting = {r.o_orderkey for r in orders.filter("o_orderpriority not in ('1-URGENT', '5-LOW')").collect()}
    assert waiting and waiting <= {r.ingest_seq for r in QUERIES["recent_catalog_view"](spark, FOLDER).collect()}
