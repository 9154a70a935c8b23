"""Plan properties: what the physical plans must look like, not only what they return."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF", "MapInArrow")


def _final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def _scans(plan: str) -> int:
    return len(re.findall(r"FileScan parquet|Scan parquet", plan))


def test_scorecard_reads_the_table_once(spark):
    plan = _final_plan(E.q_completeness_scorecard(spark, SF_SMALL))
    assert "isFinalPlan=true" in plan
    assert _scans(plan) == 1, plan
    assert "ReusedExchange" in plan


def test_scorecard_reads_only_rule_columns(spark):
    df = E.q_completeness_scorecard(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    cols = {c.split(":")[0] for c in schema.split(",")}
    assert cols == {"o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"}


def test_accuracy_report_reads_each_side_once(spark):
    plan = _final_plan(E.q_accuracy_report(spark, SF_SMALL))
    assert _scans(plan) == 2, plan
    # no join of raw source rows: the only joins are between the two per-key aggregates
    assert plan.count("Join") <= 2


def test_violation_filters_reach_the_scan(spark):
    for key, pushed in (
        ("rule_in_list", "o_orderpriority"),
        ("rule_between", "o_totalprice"),
        ("filter_gt", "GreaterThan(o_totalprice,400000.0)"),
    ):
        df = E.core_queries()[key](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        m = re.search(r"PushedFilters: \[([^\]]*)\]", plan)
        assert m and pushed in m.group(1), (key, plan)


@pytest.mark.parametrize("key", sorted(E.core_queries()))
def test_no_python_in_plans(spark, key):
    df = E.core_queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(n in plan for n in PYTHON_NODES), plan


def test_accuracy_report_hot_key_path_reuses_the_aggregates(spark):
    from vigil.operators.accuracy import accuracy_report

    s, t = E.table_s(spark, SF_SMALL), E.table_t(spark, SF_SMALL)
    df = accuracy_report(s, t, E.KEYS, [E.PRICE_MAX, E.QTY_SUM], chunk_rows=1)
    plan = _final_plan(df)
    assert _scans(plan) == 2, plan
    assert "ReusedExchange" in plan or "ReusedQueryStage" in plan or plan.count("ShuffleQueryStage") >= 2
    assert df.count() == s.count()


def test_full_outer_join_of_key_rows_is_at_key_level(spark):
    plan = re.sub(r"#\d+L?", "", _final_plan(E.q_outer_join_keys(spark, SF_SMALL)))
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FullOuter" in line)
    # the key rows enter the join already counted per key, not as raw rows
    assert any("functions=[count(1)]" in line for line in lines[at + 1: at + 4]), plan
    # the expansion spreads over a fixed task count that AQE may not coalesce
    assert "REPARTITION_BY_NUM" in plan
