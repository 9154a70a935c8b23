import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SITE_RULES
from vigil.functions.rules import Rule
from vigil.operators import completeness as C


def _by_column(rows):
    return {r["column"]: r for r in rows}


def test_site_scorecard_golden(sites):
    card = _by_column(C.scorecard(sites, SITE_RULES, "ods", "sites").collect())
    assert set(card) == set(SITE_RULES)
    bad = {"site_name": "NULL", "longitude": "150.0", "latitude": "-20.0", "address": "NULL"}
    for col, row in card.items():
        assert row["database"] == "ods" and row["table"] == "sites"
        assert row["count_data"] == 2
        if col in bad:
            assert row["count_valid"] == 1
            assert row["percentage_valid"] == 50.0
            assert json.loads(row["data_invalid"]) == [{"value": bad[col], "count": 1}]
        else:
            assert row["count_valid"] == 2
            assert row["percentage_valid"] == 100.0
            assert row["data_invalid"] == "[]"


def test_scorecard_schema(sites):
    card = C.scorecard(sites, SITE_RULES, "ods", "sites")
    assert [(f.name, f.dataType.simpleString()) for f in card.schema.fields] == [
        ("database", "string"), ("table", "string"), ("column", "string"),
        ("count_data", "bigint"), ("count_valid", "bigint"),
        ("percentage_valid", "double"), ("data_invalid", "string"),
    ]


def test_null_rule_result_is_valid_in_scorecard_but_fails_rate(spark):
    df = spark.createDataFrame([("REGIONAL 1",), ("X",), (None,)], "r string")
    rule = {"r": "r LIKE 'REGIONAL%'"}
    row = C.scorecard(df, rule).collect()[0]
    assert (row["count_data"], row["count_valid"]) == (3, 2)
    assert json.loads(row["data_invalid"]) == [{"value": "X", "count": 1}]
    rate = C.completeness_rate(df, rule).collect()[0]["rate"]
    assert rate == pytest.approx(1 / 3)
    flags = sorted(r["valid"] for r in C.rule_flags(df, rule).collect())
    assert flags == [0, 0, 1]


def test_regex_rules_find_semantics(spark):
    df = spark.createDataFrame([("12345678901",), ("a1b",), ("zz",), (None,)], "lac string")
    bad = [r["lac"] for r in C.violations(df, "lac RLIKE '([0-9]{1,7})'").collect()]
    assert bad == ["zz"]
    df2 = spark.createDataFrame([("xABC1234y",), ("ABC123",), ("AB123",)], "s string")
    bad2 = [r["s"] for r in C.violations(df2, "s RLIKE '([A-Z]{3})([0-9]{3})'", text_form=True).collect()]
    assert bad2 == ["AB123"]


def test_distinct_and_labels(sites):
    rows = _by_column(C.invalid_distinct_values(sites, SITE_RULES).collect())
    assert rows["site_name"]["distinct_invalid"] == "NULL"
    assert rows["longitude"]["distinct_invalid"] == "150.0"
    assert rows["regional"]["distinct_invalid"] == ""
    rows = _by_column(C.invalid_distinct_values(sites, SITE_RULES, label="NULL Value").collect())
    assert rows["address"]["distinct_invalid"] == "NULL Value"


def test_empty_table(spark):
    df = spark.createDataFrame([], "x int")
    row = C.scorecard(df, {"x": "x > 0"}).collect()[0]
    assert (row["count_data"], row["count_valid"], row["percentage_valid"], row["data_invalid"]) == (0, 0, 0.0, "[]")
    assert C.completeness_rate(df, {"x": "x > 0"}).collect()[0]["rate"] is None
    assert C.pass_percentage(df, "x > 0").collect()[0][0] == 0.0


def test_two_rules_on_one_column(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    rules = [Rule("x_positive", "x > 1", column="x"), Rule("x_small", "x < 3", column="x")]
    card = _by_column(C.scorecard(df, rules).collect())
    assert json.loads(card["x_positive"]["data_invalid"]) == [{"value": "1", "count": 1}]
    assert json.loads(card["x_small"]["data_invalid"]) == [{"value": "5", "count": 1}]


def _expected_card(rows):
    """What the two rules below find in (x, s) rows, in plain Python."""
    from collections import Counter

    tests = {
        "x": (0, lambda x: -2 <= x <= 2),
        "s": (1, lambda s: s.startswith("a")),
    }
    card = {}
    for name, (at, holds) in tests.items():
        broken = Counter(str(r[at]) for r in rows if r[at] is not None and not holds(r[at]))
        listed = [{"value": v, "count": c} for v, c in sorted(broken.items(), key=lambda e: (-e[1], e[0]))]
        card[name] = (len(rows), len(rows) - sum(broken.values()), json.dumps(listed, separators=(",", ":")))
    return card


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.one_of(st.none(), st.sampled_from(["a", "b", "ab", "c"]))),
        max_size=40,
    )
)
def test_single_pass_equals_definition(spark, data):
    df = spark.createDataFrame(data, "x int, s string")
    rules = {"x": "x BETWEEN -2 AND 2", "s": "s LIKE 'a%'"}
    got = {r["column"]: (r["count_data"], r["count_valid"], r["data_invalid"]) for r in C.scorecard(df, rules).collect()}
    assert got == _expected_card(data)
    prof = C.invalid_value_profile(df, rules).collect()
    for name in rules:
        n, valid, _ = got[name]
        assert n - valid == sum(r["count"] for r in prof if r["column_name"] == name)


def test_ordered_text_over_many_slices(spark):
    """A rule with thousands of failing values, spread over many sort slices."""
    prev = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(0, 5000).select((F.col("id") % 1700).alias("v"))
        card = C.scorecard(df, {"v": "v < 10"}).collect()[0]
        got = json.loads(card["data_invalid"])
        counts = {}
        for i in range(5000):
            if i % 1700 >= 10:
                counts[str(i % 1700)] = counts.get(str(i % 1700), 0) + 1
        want = [{"value": v, "count": c} for c, v in sorted((-c, v) for v, c in counts.items())]
        want = [{"value": w["value"], "count": -w["count"]} for w in want]
        assert got == want
        dist = C.invalid_distinct_values(df, {"v": "v < 10"}).collect()[0]["distinct_invalid"]
        assert dist == "|".join(sorted(counts))
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)


def test_group_count_desc_and_distinct(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,), (None,)], "c string")
    rows = [(r["value"], r["count"]) for r in C.group_count_desc(df, "c").collect()]
    assert rows == [("NULL", 3), ("b", 2), ("a", 1)]
    assert sorted(r["c"] or "" for r in C.distinct_values(df, "c").collect()) == ["", "a", "b"]


def test_counts_only_scorecard_matches(sites):
    full = {r["column"]: tuple(r)[:6] for r in C.scorecard(sites, SITE_RULES, "ods", "sites").collect()}
    lean = C.scorecard(sites, SITE_RULES, "ods", "sites", invalid=None)
    assert "data_invalid" not in lean.columns
    assert {r["column"]: tuple(r) for r in lean.collect()} == full


def test_many_rules_share_one_scan(spark, tmp_path):
    spark.range(500).selectExpr("CAST(id AS INT) AS x").write.parquet(str(tmp_path / "t"))
    rules = [Rule(f"x{i}", f"x > {i}", column="x") for i in range(250)]
    profile = C.invalid_value_profile(spark.read.parquet(str(tmp_path / "t")), rules)
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    rows = profile.collect()
    assert len(rows) == sum(i + 1 for i in range(250)) and all(r["count"] == 1 for r in rows)


def test_text_profiles_read_the_table_once(spark, tmp_path):
    spark.range(50).selectExpr("CAST(id % 7 AS INT) AS x").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for profile in (C.invalid_profile_json, C.invalid_distinct_values):
        plan = profile(df, {"x": "x > 3"})._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
    assert C.invalid_distinct_values(df, {"x": "x > 3 -- floor"}).collect()[0]["distinct_invalid"] == "0|1|2|3"
    assert C.invalid_profile_json(df, {"x": "x >= 0"}).collect()[0]["data_invalid"] == "[]"


def test_null_and_label_text_are_one_value(spark):
    df = spark.createDataFrame([("NULL",), (None,), ("ok",)], "s string")
    row = C.scorecard(df, {"s": "s IS NOT NULL AND s = 'ok'"}).first()
    assert json.loads(row["data_invalid"]) == [{"value": "NULL", "count": 2}]
    num = spark.createDataFrame([(1.5,), (None,), (1.5,), (2.0,)], "d double")
    row = C.scorecard(num, {"d": "coalesce(d > 5, false)"}).first()
    assert json.loads(row["data_invalid"]) == [
        {"value": "1.5", "count": 2}, {"value": "2.0", "count": 1}, {"value": "NULL", "count": 1}]


def test_typed_slots_render_dates_booleans_decimals(spark):
    import datetime as dt
    from decimal import Decimal

    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1), False, Decimal("1.50")), (dt.date(2024, 1, 1), True, Decimal("1.50")),
         (None, None, None)],
        "d date, b boolean, x decimal(5,2)",
    )
    rules = {"d": "coalesce(d > DATE '2024-06-01', false)", "b": "coalesce(b, false)", "x": "coalesce(x > 2, false)"}
    card = {r["column"]: json.loads(r["data_invalid"]) for r in C.scorecard(df, rules).collect()}
    assert card["d"] == [{"value": "2024-01-01", "count": 2}, {"value": "NULL", "count": 1}]
    assert card["b"] == [{"value": "NULL", "count": 1}, {"value": "false", "count": 1}]
    assert card["x"] == [{"value": "1.50", "count": 2}, {"value": "NULL", "count": 1}]
