"""Registered queries against their SQL, and the shape of their plans."""

import re

import pytest
from check import compare, duck

from sonoloom.plans import load

REGISTRY = load()


@pytest.fixture(scope="module")
def con(tiny):
    return duck(tiny)


@pytest.mark.parametrize("name", sorted(REGISTRY.QUERIES))
def test_query(spark, con, tiny, name):
    verdict, _, _ = compare(spark, con, name, REGISTRY.QUERIES[name], REGISTRY.CHECKS.get(name), tiny)
    assert verdict.startswith(("ok", "rows-only")) and "TYPES" not in verdict, verdict


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins_and_no_single_task_rows(spark, tiny):
    for name in ("total_cap", "partial_sets", "speaker_budget", "fixed_batches", "quota_batches", "filter_spec_full"):
        plan = plan_of(REGISTRY.QUERIES[name](spark, tiny))
        assert "CartesianProduct" not in plan, name
        windows = re.findall(r"Window \[[^\]]*\](?:, \[([^\]]*)\])?", plan)
        assert windows, name


def test_filters_and_columns_reach_the_scan(spark, tiny):
    plan = plan_of(REGISTRY.QUERIES["select_candidates"](spark, tiny))
    scans = [s for s in plan.split("\n") if "FileScan" in s]
    lineitem = next(s for s in scans if "l_orderkey" in s)
    assert "l_extendedprice" not in lineitem and "l_linestatus" in lineitem
    assert "PushedFilters: [" in lineitem and "IsNotNull(l_linestatus)" in lineitem
    assert "Exchange" in plan and "BatchEvalPython" not in plan


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
