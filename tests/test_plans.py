"""Plan shape: no Python in the core, no cartesian products, partial aggregation."""

import pytest

from slotplan.plans import catalog
from tests.conftest import SF_SMALL

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_no_cartesian(spark, name):
    text = plan_text(catalog.QUERIES[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in text, f"{name} plan contains {bad}"
    assert "REPARTITION_BY_NUM" not in text, f"{name} shuffles right after a scan"


def test_planner_aggregates_before_shuffle(spark):
    text = plan_text(catalog.QUERIES["q_item_planner"](spark, SF_SMALL))
    assert "partial_max" in text
    scan = catalog.QUERIES["q_item_planner"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey" in scan or "lineitem" in scan


def test_prefix_plan_has_no_slot_window(spark):
    """The naive plan ranks inside at most |slots| window partitions; the prefix plan
    has no window at all (only aggregates, with partial aggregation before each shuffle)."""
    from slotplan.plans.q_items import item_planner, item_planner_naive
    prefix = plan_text(item_planner(spark, SF_SMALL))
    naive = plan_text(item_planner_naive(spark, SF_SMALL))
    assert "Window" not in prefix and "Window" in naive
    assert prefix.count("partial_max") >= 2
