"""Plan properties that matter at scale, checked on every registered query."""

import pytest

from conftest import SF_SMALL
from shelfwise.plans.registry import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _names():
    return sorted(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_no_pairwise_joins_or_row_python(spark, name):
    from __spark_entry__ import queries
    plan = _plan(queries()[name](spark, SF_SMALL))
    for bad in ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]:
        assert bad not in plan, f"{name} plans a {bad}"


@pytest.mark.parametrize("name", ["q26", "q35"])
def test_rank_filters_limit_before_shuffle(spark, name):
    from __spark_entry__ import queries
    assert "WindowGroupLimit" in _plan(queries()[name](spark, SF_SMALL))


def test_latest_snapshot_prunes_partitions(spark):
    from __spark_entry__ import queries
    plan = _plan(queries()["v03"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(date" in plan and "subquery" in plan.split("PartitionFilters:")[1][:200]


def test_scans_prune_columns(spark):
    from __spark_entry__ import queries
    plan = _plan(queries()["q04"](spark, SF_SMALL))
    assert "ReadSchema: struct<quantity_sold:int,channel:string,revenue:decimal(18,2)>" in plan


def test_no_pairwise_joins_without_broadcast(spark):
    """With broadcasts disabled (dimensions too large to broadcast), every join
    still has equi-keys: no query falls back to a Cartesian or nested-loop join."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        for name, fn in sorted(QUERIES.items()):
            plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["q37", "p03"])
def test_date_windows_prune_sales_months(spark, name):
    from __spark_entry__ import queries
    plan = _plan(queries()[name](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(sale_month" in plan
