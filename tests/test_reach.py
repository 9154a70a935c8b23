"""One day, a span of days, and keys of either side."""

import datetime as dt

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.test_plans import _final_plan, _scans
from vigil.functions.dates import checked_day
from vigil.operators.accuracy import AccuracyRule, join_type, reconcile, reconcile_outer
from vigil.operators.availability import availability, missing_intervals
from vigil.plans.catalog import parse_section


def test_a_checked_day_prunes_partitions(spark, tmp_path):
    rows = [(dt.date(2024, 1, d), d) for d in range(1, 6)]
    path = str(tmp_path / "days")
    spark.createDataFrame(rows, "day date, v int").write.partitionBy("day").parquet(path)
    df = spark.read.parquet(path)
    got = df.where(checked_day(df, "DAY", "days:-1", "2024-01-04"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-01-03" in filters and "2024-01-04" in filters, plan
    assert [r["v"] for r in got.collect()] == [3]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string"])
def test_a_checked_day_of_every_type(spark, kind):
    texts = ["2024-01-02 23:59:59", "2024-01-03 00:00:00", "2024-01-03 23:59:59", "2024-01-04 00:00:00", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    df = rows.selectExpr(f"CAST(t AS {kind}) AS t") if kind != "string" else rows.selectExpr("substr(t, 1, 10) AS t")
    got = df.where(checked_day(df, "t", -1, "2024-01-04")).selectExpr("CAST(t AS string) AS t").collect()
    assert len(got) == 2 and {r["t"][:10] for r in got} == {"2024-01-03"}


def test_other_date_formats_are_refused():
    with pytest.raises(ValueError, match="dates are read"):
        parse_section("dq_x", {"measure": {"completeness": {"date_format": "%d.%m.%Y", "dq_rules": {}}}})


def test_availability_lists_empty_intervals(spark):
    at = ["2024-01-01 10:00:00", "2024-01-01 11:59:59", "2024-01-03 00:00:00", "2024-01-09 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in at], "t string").selectExpr("CAST(t AS timestamp_ntz) AS t")
    span = availability(df, "t", "days:-4", "days:-1", as_of="2024-01-05", database="d", table="t")
    assert [(r["interval"], r["count_data"], r["available"]) for r in sorted(span.collect())] == [
        ("2024-01-01", 2, True), ("2024-01-02", 0, False), ("2024-01-03", 1, True), ("2024-01-04", 0, False)]
    assert [r["interval"] for r in sorted(missing_intervals(span).collect())] == ["2024-01-02", "2024-01-04"]
    hours = availability(df, "t", -4, -4, "hours", "2024-01-05").collect()
    assert len(hours) == 24 and {r["interval"] for r in hours if r["available"]} == {"2024-01-01 10:00", "2024-01-01 11:00"}
    weeks = sorted(availability(df, "t", -4, 4, "weeks", "2024-01-05").collect())
    assert [(r["interval"], r["count_data"]) for r in weeks] == [("2024-01-01", 3), ("2024-01-08", 1)]
    months = availability(df, "t", -40, 4, "months", "2024-01-05").collect()
    assert {(r["interval"], r["count_data"]) for r in months} == {("2023-11", 0), ("2023-12", 0), ("2024-01", 4)}
    text = df.selectExpr("CAST(CAST(t AS date) AS string) AS t")
    assert {r["interval"] for r in availability(text, "t", -4, -1, as_of="2024-01-05").collect() if r["available"]} == {
        "2024-01-01", "2024-01-03"}
    assert availability(df.where("false"), "t", -4, -1, as_of="2024-01-05").where("available").count() == 0
    assert availability(df, "t", -1, -4, as_of="2024-01-05").count() == 0
    with pytest.raises(ValueError):
        availability(df, "t", unit="minutes")
    with pytest.raises(TypeError):
        availability(text, "t", unit="hours")


def test_availability_scans_once_and_pushes_the_span(spark):
    plan = _final_plan(E.q_availability(spark, SF_SMALL))
    assert _scans(plan) == 1
    assert "GreaterThanOrEqual(ts,2024-01-25" in plan and "LessThan(ts,2024-02-02" in plan


RULE = AccuracyRule("m", "v", "v", "sum", 0)


def test_keys_of_either_side(spark):
    s = spark.createDataFrame([(1, 1), (1, 2), (2, 5), (None, 7)], "k int, v int")
    t = spark.createDataFrame([(1, 3), (3, 1), (None, 7), (None, 1)], "part int, v int")
    rows = {(r["k"], r["presence"]): (r["sum_source_v"], r["sum_target_v"], r["m_check"])
            for r in reconcile_outer(s, t, "k", [RULE], "Part").collect()}
    assert rows == {
        (1, "both"): (3, 3, True), (2, "source"): (5, None, None), (3, "target"): (None, 1, None),
        (None, "source"): (7, None, None), (None, "target"): (None, 8, None),
    }
    kinds = lambda how: sorted(r["presence"] for r in reconcile_outer(s, t, "k", [RULE], "part", how).collect())
    assert kinds("inner") == ["both"] and kinds("left") == ["both", "source", "source"]
    assert kinds("right outer") == ["both", "target", "target"]
    same = reconcile_outer(s, s, "k", [RULE], how="inner").drop("presence")
    assert sorted(same.collect()) == sorted(reconcile(s, s, "k", [RULE]).collect())


def test_keys_that_do_not_match_up(spark):
    s = spark.createDataFrame([(1, 1)], "k int, v int")
    with pytest.raises(ValueError, match="1 source keys and 2 target keys"):
        reconcile_outer(s, s, "k", [RULE], "k,v")
    with pytest.raises(ValueError, match="no key column 'nope'"):
        reconcile_outer(s, s, "k", [RULE], "nope")
    with pytest.raises(ValueError, match="join type"):
        join_type("cross")


def test_a_key_column_that_is_also_measured(spark):
    s = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    t = spark.createDataFrame([(10, 1), (20, 3)], "k int, v int")  # the target's key is its v
    rule = AccuracyRule("m", "v", "k", "max", 0)
    rows = {(r["k"], r["presence"], r["m_check"]) for r in reconcile_outer(s, t, "k", [rule], "v").collect()}
    assert rows == {(1, "both", True), (2, "source", None), (3, "target", None)}


def test_both_kinds_of_unmatched_keys_occur(spark):
    rows = E.q_outer_join_keys(spark, SF_SMALL)
    source = E.table_s(spark, SF_SMALL).select("k1", "k2").distinct()
    assert rows.where("max_target_price IS NULL").count() > 0  # source alone
    assert rows.join(source, ["k1", "k2"], "left_anti").count() > 0  # target alone
    assert _scans(_final_plan(E.q_outer_join_keys(spark, SF_SMALL))) == 2
    kinds = {r["presence"] for r in E.q_reconcile_outer(spark, SF_SMALL).select("presence").distinct().collect()}
    assert kinds == {"both", "source", "target"}


def test_thresholds_that_are_no_numbers():
    with pytest.raises(ValueError, match="threshold"):
        AccuracyRule("m", "v", "v", "max", "a lot")
