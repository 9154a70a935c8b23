"""Rules that look into other tables, in every form of the scorecard."""

import json
import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from vigil.functions.rules import Rule, listed_in, used_columns
from vigil.operators import completeness as C

VALUES = [1, 2, None]
LISTS = {"with_null": [1, None], "plain": [1, 1], "empty": []}


def _in(value, values):
    """SQL's ``value IN (values)``: True, False or None."""
    if not values:
        return False
    if value is not None and value in values:
        return True
    return None if value is None or None in values else False


def _not(truth):
    return None if truth is None else not truth


@pytest.fixture(params=sorted(LISTS))
def listed(request, spark):
    spark.createDataFrame([(v,) for v in LISTS[request.param]], "y int").createOrReplaceTempView("listed")
    return LISTS[request.param]


@pytest.mark.parametrize("form", ["in", "not_in", "listed_in", "exists", "and", "or"])
def test_nulls_count_as_sql_counts_them(spark, listed, form):
    rule, truth = {
        "in": ("x IN (SELECT y FROM listed)", lambda v: _in(v, listed)),
        "not_in": ("x NOT IN (SELECT y FROM listed)", lambda v: _not(_in(v, listed))),
        "listed_in": (listed_in("x", "SELECT y FROM listed -- a list"), lambda v: _in(v, listed)),
        "exists": ("EXISTS (SELECT 1 FROM listed WHERE y = x)", lambda v: v is not None and v in listed),
        "and": ("x IN (SELECT y FROM listed) AND true", lambda v: _in(v, listed)),
        "or": ("x IN (SELECT y FROM listed) OR x IS NULL", lambda v: True if v is None else _in(v, listed)),
    }[form]
    df = spark.createDataFrame([(v,) for v in VALUES], "x int")
    bad = [v for v in VALUES if truth(v) is False]
    shown = sorted("NULL" if v is None else str(v) for v in bad)
    assert sorted(str(r["x"]).replace("None", "NULL") for r in C.violations(df, rule).collect()) == shown
    card = C.scorecard(df, {"x": rule}).first()
    assert (card["count_data"], card["count_valid"]) == (3, 3 - len(bad))
    assert sorted(v["value"] for v in json.loads(card["data_invalid"])) == shown
    assert sorted(r["value"] for r in C.invalid_value_profile(df, {"x": rule}).collect()) == shown
    assert C.invalid_distinct_values(df, {"x": rule}).first()["distinct_invalid"] == "|".join(shown)
    assert C.scorecard(df, {"x": rule}, invalid=None).first()["count_valid"] == 3 - len(bad)
    good = sum(truth(v) is True for v in VALUES)
    assert C.completeness_rate(df, {"x": rule}).first()["rate"] == pytest.approx(good / 3)


def test_the_measured_table_is_scanned_once(spark):
    table, rules = E._customers(spark, SF_SMALL)
    chosen = [r for r in rules if r.name in ("in_region", "ordered", "key")]
    plan = C._long_profile(table, chosen, "NULL", with_total=True)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert sum("c_custkey" in s for s in scans) == 1, plan


def test_a_long_list_is_joined_by_key(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    spark.read.parquet(f"{SF_SMALL}/customer.parquet").createOrReplaceTempView("long_list")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rule = {"o_custkey": listed_in("o_custkey", "SELECT c_custkey FROM long_list")}
        for df in (C.scorecard(orders, rule), C.violations(orders, rule["o_custkey"])):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "BroadcastExchange" not in plan and "ExistenceJoin" in plan, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_columns_that_rules_read(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "Site int, other int, Lac int, unused int")
    spark.createDataFrame([(1,)], "y int").createOrReplaceTempView("listed")
    rules = ["(site IN (SELECT y FROM listed))", "EXISTS (SELECT 1 FROM listed WHERE y = LAC)", "`OTHER`"]
    assert used_columns(df, rules) == ["Site", "other", "Lac"]


def test_rule_columns_in_another_case_keep_their_type(spark):
    df = spark.createDataFrame([(1.5,), (2.5,), (None,)], "Lon double")
    types, where = C._slots(df, [Rule("lon", "lon < 1")], "NULL")
    assert types == ["double"] and where["lon"][0] == 0
    assert C.scorecard(df, {"lon": "lon < 2"}).first()["data_invalid"] == '[{"value":"2.5","count":1}]'


def test_text_is_rendered_once_per_value(spark):
    df = E.q_invalid_profile_json(spark, SF_SMALL)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("StructsToJsonEvaluator") == 1
