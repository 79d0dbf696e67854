"""Physical-plan guards for every registered marketplace query (sf0.001).

No query may plan a Cartesian product or a broadcast nested-loop join (the
shape of a cross join) or evaluate Python per row; the flagship must prune
and push down at the scan and combine rows before its first shuffle.
"""

import pytest

from lodgeflow.plans import registry as R

SF = "/root/testdata/sf0.001"


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _keys():
    return sorted(R.queries())


@pytest.mark.parametrize("key", _keys())
def test_no_cross_join_shapes(spark, key):
    plan = physical_plan(R.queries()[key](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "FlatMapGroupsInPandas" not in plan   # JVM-side only


def test_flagship_prunes_pushes_and_combines_early(spark):
    df = R.queries()["price_by_sentiment"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    lineitem_scan = [line for line in plan.splitlines() if "lineitem" in line and "FileScan" in line]
    assert lineitem_scan, plan
    scan = lineitem_scan[0]
    assert "PushedFilters: [IsNotNull(l_shipdate)" in scan
    assert "l_extendedprice" not in scan and "l_tax" not in scan          # column pruning
    # the per-(listing, sentiment) count is partial before it is exchanged
    assert "partial_count" in plan
