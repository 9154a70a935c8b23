import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vigil.operators import accuracy as A

SCHEMA = "lac int, ci int, lon double, f int"
# Accuracy golden case (keys lac, ci).
SOURCE = [(1, 1, 1.0, 5), (1, 1, 2.0, 6), (2, 2, 3.0, 7), (3, None, 9.0, 1), (4, 4, 1.0, 1)]
TARGET = [(1, 1, 2.5, 11), (2, 2, 1.0, 7), (9, 9, 1.0, 1), (3, None, 9.0, 1), (4, 4, None, None)]
RULES = {
    "max_of_lon": {"source_cols": "lon", "target_cols": "lon", "aggfunc": "max", "threshold": 0.02},
    "sum_of_f": {"source_cols": "f", "target_cols": "f", "aggfunc": "sum"},
}
EXPECTED = sorted(
    [
        (1, 1, 2.0, 2.5, True, 11, 11, True),
        (1, 1, 2.0, 2.5, True, 11, 11, True),
        (2, 2, 3.0, 1.0, False, 7, 7, True),
        (3, None, None, None, None, None, None, None),
        (4, 4, 1.0, None, None, 1, None, None),
    ],
    key=repr,
)


@pytest.fixture(scope="module")
def sides(spark):
    return spark.createDataFrame(SOURCE, SCHEMA), spark.createDataFrame(TARGET, SCHEMA)


def test_report_golden(sides):
    s, t = sides
    rep = A.accuracy_report(s, t, "lac, ci", RULES)
    assert rep.columns == [
        "lac", "ci", "max_source_lon", "max_target_lon", "lon_accuracy", "sum_source_f", "sum_target_f", "f_accuracy",
    ]
    assert sorted((tuple(r) for r in rep.collect()), key=repr) == EXPECTED


def test_report_hot_key_path_is_identical(sides):
    s, t = sides
    for hot in (1, 2):
        rep = A.accuracy_report(s, t, "lac,ci", RULES, chunk_rows=hot)
        assert sorted((tuple(r) for r in rep.collect()), key=repr) == EXPECTED


def test_by_key_and_reconcile(sides):
    s, t = sides
    rows = {(r["lac"], r["ci"]): r for r in A.accuracy_by_key(s, t, ["lac", "ci"], RULES).collect()}
    assert set(rows) == {(1, 1), (2, 2), (4, 4)}
    assert rows[(2, 2)]["lon_accuracy"] is False and rows[(4, 4)]["lon_accuracy"] is None
    rec = A.reconcile(s, t, "lac,ci", RULES)
    assert rec.columns[-2:] == ["max_of_lon_check", "sum_of_f_check"]
    one = A.rule_check(s, t, "lac,ci", A.AccuracyRule("m", "lon", "lon", "max", 0.02))
    assert one.columns == ["lac", "ci", "max_source_lon", "max_target_lon", "lon_accuracy"]


def _expected_report(source, target, threshold):
    """The report from its definition, in plain Python: rows are (key, key, price, qty)."""
    def over(function, values):
        there = [v for v in values if v is not None]
        return function(there) if there else None

    def by_key(rows):
        groups = {}
        for *key, price, qty in rows:
            if None not in key:
                groups.setdefault(tuple(key), []).append((price, qty))
        return {k: (over(max, [p for p, _ in v]), over(sum, [q for _, q in v])) for k, v in groups.items()}

    def agrees(mine, other, most):
        return None if mine is None or other is None else mine - other <= most

    ours, theirs = by_key(source), by_key(target)
    report = []
    for *key, _, _ in source:
        key = tuple(key)
        if key in ours and key in theirs:
            (p, x), (q, y) = ours[key], theirs[key]
            report.append((*key, p, q, agrees(p, q, threshold), x, y, agrees(x, y, 0)))
        else:
            report.append((*key, *[None] * 6))
    return sorted(report, key=repr)


def test_report_equals_its_definition(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    s = li.selectExpr("l_partkey % 50 AS k1", "l_suppkey AS k2", "l_extendedprice AS price", "l_quantity AS qty")
    t = li.where("l_linenumber <> 7").selectExpr(
        "l_partkey % 50 AS k1", "l_suppkey AS k2",
        "CASE WHEN l_linenumber = 3 THEN l_extendedprice - 1 ELSE l_extendedprice END AS price", "l_quantity AS qty",
    )
    rules = A.as_accuracy_rules(
        {"p": {"source_cols": "price", "target_cols": "price", "aggfunc": "max", "threshold": 0.02},
         "q": {"source_cols": "qty", "target_cols": "qty", "aggfunc": "sum"}}
    )
    fast = A.accuracy_report(s, t, ["k1", "k2"], rules, chunk_rows=3)
    got = sorted(map(tuple, fast.collect()), key=repr)
    want = _expected_report([tuple(r) for r in s.collect()], [tuple(r) for r in t.collect()], 0.02)
    assert [r[:5] + r[7:] for r in got] == [r[:5] + r[7:] for r in want]
    assert [r[5:7] for r in got] == [pytest.approx(r[5:7]) for r in want]


def test_rule_errors(sides):
    s, t = sides
    with pytest.raises(ValueError):
        A.AccuracyRule("x", "lon", "lon", "avg")
    with pytest.raises(ValueError):  # two rules, one output name
        A.accuracy_report(s, t, "lac,ci", [A.AccuracyRule("a", "lon", "lon", "max", 0.1), A.AccuracyRule("b", "lon", "lon", "max", 0.2)])
    txt = s.withColumn("lon", F.col("lon").cast("string"))
    with pytest.raises(TypeError):
        A.accuracy_report(txt, t, "lac,ci", RULES)
    with pytest.raises(ValueError):
        A.parse_keys(" , ")


def test_absolute_option(sides):
    s, t = sides
    rule = A.AccuracyRule("m", "lon", "lon", "max", 0.02, absolute=True)
    rows = {(r["lac"], r["ci"]): r["lon_accuracy"] for r in A.rule_check(s, t, "lac,ci", rule).collect()}
    assert rows[(1, 1)] is False  # |2.0 - 2.5| > 0.02, the signed check would pass


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_key = st.one_of(st.none(), st.integers(0, 3))
_row = st.tuples(_key, _key, st.one_of(st.none(), st.integers(-3, 3)))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_row, max_size=25), st.lists(_row, max_size=25), st.integers(1, 4))
def test_report_on_random_keys(spark, src_rows, tgt_rows, chunk):
    schema = "a int, b int, v int"
    s, t = spark.createDataFrame(src_rows, schema), spark.createDataFrame(tgt_rows, schema)
    rules = A.as_accuracy_rules(
        {"mx": {"source_cols": "v", "target_cols": "v", "aggfunc": "max", "threshold": 1},
         "sm": {"source_cols": "v", "target_cols": "v", "aggfunc": "sum"}}
    )
    # two rules on one target column would clash on "v_accuracy": give the sum its own copy
    s2, t2 = s.withColumn("w", F.col("v")), t.withColumn("w", F.col("v"))
    rules = [rules[0], A.AccuracyRule("sm", "w", "w", "sum", 0)]
    fast = A.accuracy_report(s2, t2, ["a", "b"], rules, chunk_rows=chunk)
    want = _expected_report([(*r, r[2]) for r in src_rows], [(*r, r[2]) for r in tgt_rows], 1)
    assert sorted(map(tuple, fast.collect()), key=repr) == want


_k = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(_k, _k), max_size=20), st.lists(st.tuples(_k, _k, st.integers(0, 9)), max_size=12),
       st.integers(1, 3))
def test_join_key_rows_equals_plain_join(spark, left_rows, right_rows, chunk):
    left = spark.createDataFrame(left_rows, "a int, b int")
    right = spark.createDataFrame(right_rows, "a int, b int, x int")
    for how in ("inner", "left", "right", "full_outer"):
        fast = A.join_key_rows(left, right, "a,b", how, chunk_rows=chunk)
        plain = left.join(right, ["a", "b"], how).select(*fast.columns)
        assert sorted(map(tuple, fast.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr), how


def test_join_key_rows_rejects_non_key_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, z int")
    with pytest.raises(ValueError):
        A.join_key_rows(df, df, "a")


def test_expansion_partitions(spark, sides):
    from vigil.session import shuffle_partitions_for

    assert shuffle_partitions_for(100 * 1024**4) == 204800
    assert shuffle_partitions_for(1) == 200
    assert A.expansion_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    s, t = sides
    rep = A.accuracy_report(s, t, "lac,ci", RULES, partitions=3)
    assert rep.rdd.getNumPartitions() == 3
    assert sorted((tuple(r) for r in rep.collect()), key=repr) == EXPECTED


def test_decimal_columns(spark):
    from decimal import Decimal

    schema = "k int, amt decimal(12,2)"
    s = spark.createDataFrame([(1, Decimal("10.00")), (1, Decimal("5.01")), (2, Decimal("3.00"))], schema)
    t = spark.createDataFrame([(1, Decimal("15.00")), (2, Decimal("2.97"))], schema)
    rules = [A.AccuracyRule("sum_amt", "amt", "amt", "sum", 0.02)]
    rows = {r["k"]: r for r in A.accuracy_report(s, t, "k", rules).collect()}
    assert rows[1]["sum_source_amt"] == Decimal("15.01") and rows[1]["amt_accuracy"] is True   # 0.01 <= 0.02
    assert rows[2]["amt_accuracy"] is False                                                      # 0.03 >  0.02
    assert A.reconcile(s, t, "k", rules).count() == 2


def test_target_check_is_the_check_and_the_targets_other_keys(sides):
    s, t = sides
    rules = list(A.as_accuracy_rules(RULES))
    rows = s.withColumn("mine", F.lit(True)).unionByName(t.withColumn("mine", F.lit(False)))
    check = A.target_check(rows, "lac, ci", rules, "mine")
    assert check.columns == A.accuracy_by_key(s, t, "lac, ci", rules).columns
    assert sorted((tuple(r) for r in check.collect()), key=repr) == sorted([
        (1, 1, 2.0, 2.5, True, 11, 11, True),
        (2, 2, 3.0, 1.0, False, 7, 7, True),
        (9, 9, None, 1.0, None, None, 1, None),
        (3, None, None, 9.0, None, None, 1, None),
        (4, 4, 1.0, None, None, 1, None, None),
    ], key=repr)


def test_outer_join_keys_holds_the_whole_price_check(spark):
    import __spark_entry__ as E

    rows = E.q_outer_join_keys(spark, SF_SMALL)
    check = E.q_accuracy_rule_check(spark, SF_SMALL)
    assert rows.columns == check.columns
    both = rows.where("price_accuracy IS NOT NULL").distinct()
    assert both.exceptAll(check).count() == 0 and check.exceptAll(both).count() == 0
    assert rows.where("max_source_price IS NOT NULL AND max_target_price IS NULL").count() == 0
