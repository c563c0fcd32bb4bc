"""Every registered query against its SQL on the smallest tables."""

import pytest

from tenorgrid.catalog import REGISTRY
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_sql(spark, duck, name):
    entry = REGISTRY[name]
    df = entry(spark, FOLDER)
    problems, odd_types, _ = compare(duck, entry, df)
    assert not problems
    assert not odd_types
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert costly not in plan


@pytest.mark.parametrize("name", ["asof_join_inclusive", "dense_grid_ffill", "dedup_keep_last", "quantiles", "variety_gate", "rank_primary"])
def test_no_single_task_window(spark, name):
    plan = REGISTRY[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    def plan(name):
        execution = REGISTRY[name](spark, FOLDER)._jdf.queryExecution()
        return spark._jvm.PythonSQLUtils.explainString(execution, "formatted")

    between = plan("filter_between")
    assert "GreaterThanOrEqual(l_shipdate" in between and "LessThan(l_shipdate" in between
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_discount:double,l_shipdate:timestamp>" in between
    prefix = plan("filter_prefix")
    assert "StringStartsWith(p_type,EC)" in prefix and "p_retailprice" not in prefix


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
