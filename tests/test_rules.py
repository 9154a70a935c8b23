import pytest

from vigil.functions.rules import Rule, as_rules, sql_ident, sql_string


def test_sql_quoting(spark):
    assert sql_ident("a`b") == "`a``b`"
    for text in ("plain", "it's", "back\\slash", "NULL Value"):
        assert spark.sql(f"SELECT {sql_string(text)} AS t").first()["t"] == text


def test_as_rules_forms():
    assert as_rules({"x": "x > 1"}) == [Rule("x", "x > 1")]
    assert as_rules([("x", "x > 1")]) == [Rule("x", "x > 1")]
    r = Rule("x_pos", "x > 0", column="x")
    assert as_rules([r]) == [r] and r.target == "x"
    with pytest.raises(ValueError):
        as_rules({})


def test_rule_on_column_with_odd_name(spark):
    from vigil.operators.completeness import scorecard

    df = spark.createDataFrame([(1,), (None,)], "`odd name` int")
    row = scorecard(df, [Rule("odd name", "`odd name` IS NOT NULL")]).first()
    assert (row["count_data"], row["count_valid"], row["data_invalid"]) == (2, 1, '[{"value":"NULL","count":1}]')
