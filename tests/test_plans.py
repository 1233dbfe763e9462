"""Plan shape: pushdown, pruning, map-side dedupe, one scan for one-pass gold, no Python."""

from __future__ import annotations

import pytest
from conftest import SMALL

from visitflow.operators import gold, silver
from visitflow.plans.catalog import QUERIES
from visitflow.sources.fixture import read_bronze


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_plan_prunes_and_dedupes_map_side(spark):
    p = _plan(silver.clean(read_bronze(spark, SMALL)))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in p
    assert "WindowGroupLimit" in p and "Partial" in p
    # The id check sits below the dedupe exchange (at the scan), not after it.
    assert p.index("Exchange hashpartitioning(id") < p.index("% 107) = 0")


def test_one_pass_scans_silver_once(spark):
    agg = gold.aggregate_all(silver.clean(read_bronze(spark, SMALL)))
    p = _plan(agg)
    assert p.count("FileScan parquet") == 1 and "Expand" in p


def test_top10_is_distributed_topk(spark):
    p = _plan(gold.top_doctors(silver.clean(read_bronze(spark, SMALL))))
    assert "TakeOrderedAndProject" in p


@pytest.mark.parametrize(
    "name", [n for n in QUERIES if not n.startswith("stream_") and "roundtrip" not in n and n != "gold_one_pass"]
)
def test_no_python_in_plans(spark, name):
    p = _plan(QUERIES[name](spark, SMALL))
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert op not in p


def test_kpi_from_silver_scans_once(spark):
    from visitflow.operators import report

    p = _plan(report.kpi_from_silver(silver.clean(read_bronze(spark, SMALL))))
    assert p.count("FileScan parquet") == 1 and "Expand" not in p


def test_stacked_one_pass_has_three_branches(spark):
    agg = gold.aggregate_all(silver.clean(read_bronze(spark, SMALL)))
    p = _plan(gold.stacked(agg))
    # One projection for the seven unlimited tables, one top-k per limited table.
    assert p.count("TakeOrderedAndProject") == 2
    assert p.count("Expand [") == 3  # the (uncheckpointed) aggregate under each branch


def test_gold_prunes_columns_through_the_dedupe(spark):
    s = silver.clean(read_bronze(spark, SMALL))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in _plan(gold.severity_summary(s))
    assert "ts:timestamp_ntz" in _plan(gold.daily_trends(s))  # only the daily table needs it
