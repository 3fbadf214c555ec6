"""Every registered query gives the rows its SQL gives."""

import pytest

from __spark_entry__ import entry
from stratamart_checks.oracle import ORACLE_SQL
from stratamart_checks.queries import QUERIES
from stratamart.operators.broadcasting import SETTING
from tests.compare import connect, oracle_rows, rows_of

FOLDER = "/root/testdata/sf0.001"

# Operators no plan may fall back to: all pairs of two tables, and rows sent to Python.
SLOW = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups")


@pytest.fixture(scope="module")
def con():
    connection = connect(FOLDER)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


def executed(spark):
    """Plans of all queries run so far, those that wrote tables too."""
    store = spark._jsparkSession.sharedState().statusStore()
    return [store.executionsList().apply(k).physicalPlanDescription() for k in range(store.executionsCount())]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    before = len(executed(spark))
    df = QUERIES[name](spark, FOLDER)
    names, rows = rows_of(df)
    expected_names, expected = oracle_rows(con, ORACLE_SQL[name])
    assert names == expected_names
    assert rows == expected
    assert rows
    plans = executed(spark)[before:]
    assert plans or before >= 900
    assert not [slow for slow in SLOW if any(slow in plan for plan in plans)]


JOINS = ("price_lookup_join", "price_asof_join", "fact_sk_lookup", "fact_sk_point_in_time", "fact_sk_current", "gold_sales", "gold_incremental_refresh", "silver_sales", "dq_summary")


@pytest.mark.parametrize("name", JOINS)
def test_shuffled_joins_give_the_same_rows(spark, con, name):
    spark.conf.set(SETTING, "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows_of(QUERIES[name](spark, FOLDER)) == oracle_rows(con, ORACLE_SQL[name])
    finally:
        spark.conf.unset(SETTING)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0
