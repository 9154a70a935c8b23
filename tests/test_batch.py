"""The batch: one scan, nothing lost, nothing twice."""

import json

import pytest
import yaml
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.test_plans import _scans
from vigil.operators import completeness as C
from vigil.plans import runner
from vigil.plans.catalog import load_catalogs, parse_catalog
from vigil.plans.runner import PROFILE_TABLE, run, write
from vigil.sources.sinks import COMPLETENESS_TABLE, PathSink, accuracy_table
from vigil.sources.tables import MappedTables


def _sections(text):
    return parse_catalog(yaml.safe_load(text))


# -- texts in parts -----------------------------------------------------------------


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.one_of(st.none(), st.text("ab é\"|,", max_size=6)), max_size=40),
    size=st.sampled_from([1, 7, 40, 1 << 20]),
)
def test_parts_concatenate_to_the_text(spark, values, size):
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    rules = {"v": "v = 'none such' AND v IS NOT NULL", "other": "true"}
    df = df.withColumn("other", df["v"])
    parts = C.invalid_profile_parts(df, rules, part_bytes=size).collect()
    whole = {r["column"]: r["data_invalid"] for r in C.invalid_profile_json(df, rules).collect()}
    for rule in rules:
        own = sorted((r["part"], r["text"]) for r in parts if r["column"] == rule)
        assert "".join(t for _, t in own) == whole[rule]
        assert len({p for p, _ in own}) == len(own)
        longest = max([len(json.dumps(x, ensure_ascii=False).encode()) for x in json.loads(whole[rule])], default=0)
        assert all(len(t.encode()) <= size + longest + 20 for _, t in own)


def test_parts_spread_one_rule_over_tasks(spark):
    df = spark.range(20_000).selectExpr("cast(id as string) AS v").repartition(4)
    seen = []

    def keep(rows):
        from vigil.sources.sinks import stage

        kept = stage(rows, spark, "spread")
        seen.append(kept.groupBy("_s").count().collect())
        return kept

    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        from vigil.functions.text import ordered_parts

        parts = ordered_parts(df.selectExpr("1 AS g", "v"), "g", ["v"], "v", ",", keep, part_bytes=1000)
        texts = [r["text"] for r in parts.orderBy("part").collect()]
    finally:
        spark.conf.set(merge, "true")
    assert "".join(texts) == ",".join(sorted(str(i) for i in range(20_000)))
    slices = [r["count"] for r in seen[0]]
    assert len(slices) > 1 and max(slices) < 20_000


# -- one scan -------------------------------------------------------------------------


def test_counts_and_values_come_from_one_scan(spark, monkeypatch):
    plans = []
    from vigil.operators import completeness

    keep = completeness.stage
    monkeypatch.setattr(completeness, "stage", lambda df, s, name: plans.append(df) or keep(df, s, name))
    sections = [s for s in load_catalogs(E.CATALOGS) if s.name == "dq_orders"]
    result = run(sections, E._resolver(spark, SF_SMALL), as_of=E.AS_OF, measures=("completeness",))
    assert len(plans) == 1
    assert _scans(plans[0]._jdf.queryExecution().executedPlan().toString()) == 1
    for df in (result.completeness, result.profile):  # neither reads the table again
        assert df.inputFiles() and all("vigil-staged" in f for f in df.inputFiles())
    card = {r["column"]: r for r in E.q_completeness_scorecard(spark, SF_SMALL).collect()}
    for r in result.completeness.collect():
        assert (r["count_data"], r["count_valid"], r["percentage_valid"]) == tuple(
            card[r["column"]][c] for c in ("count_data", "count_valid", "percentage_valid"))
    assert sum(r["count"] for r in result.profile.collect()) == sum(r["count_data"] - r["count_valid"] for r in card.values())


def test_texts_and_parts_of_a_kept_profile(spark):
    table, rules = E.table_b(spark, SF_SMALL), E._order_rules()
    kept = C.kept_profile(table, rules)
    assert sorted(C.scorecard(table, rules, "tpch", "orders_b", profile=kept).collect()) == sorted(
        C.scorecard(table, rules, "tpch", "orders_b").collect())
    parts = C.profile_parts(kept, rules, 500).collect()
    assert sorted(parts) == sorted(C.invalid_profile_parts(table, rules, part_bytes=500).collect())


def test_empty_table(spark):
    empty = E.table_b(spark, SF_SMALL).where("false")
    kept = C.kept_profile(empty, E._order_rules())
    assert {(r["count_data"], r["percentage_valid"]) for r in C.profile_counts(kept, E._order_rules()).collect()} == {(0, 0.0)}
    assert {(r["part"], r["text"]) for r in C.profile_parts(kept, E._order_rules()).collect()} == {(0, "[]")}
    assert C.profile_rows(kept, E._order_rules()).count() == 0


# -- runs -----------------------------------------------------------------------------


PAIR = """
dq_one:
  source: {table: src}
  target: {table: tgt}
  measure:
    completeness: {dq_rules: {k: "k > 1"}}
    accuracy:
      source_filter: {groupby: k}
      dq_rules: {m: {source_cols: v, target_cols: v}}
"""


@pytest.fixture
def pair(spark):
    src = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    return run(_sections(PAIR), MappedTables({"src": src, "tgt": src}))


class Failing(PathSink):
    """Dies while it writes the table ``at``, or when it would publish."""

    def __init__(self, root, at):
        super().__init__(root)
        self.at = at

    def append(self, df, name, run_id=None):
        super().append(df, name, run_id)
        if name == self.at:
            raise OSError("the driver died")

    def publish(self, spark, run_id, names):
        if self.at == "publish":
            raise OSError("the driver died")
        super().publish(spark, run_id, names)


@pytest.mark.parametrize("at", [COMPLETENESS_TABLE, PROFILE_TABLE, accuracy_table("src", "tgt"), "publish"])
def test_a_run_that_failed_is_written_once(spark, pair, tmp_path, at):
    sink = PathSink(str(tmp_path))
    write(pair, sink, run_id="day-1")
    with pytest.raises(OSError):
        write(pair, Failing(str(tmp_path), at), run_id="day-2")
    one = {COMPLETENESS_TABLE: 1, PROFILE_TABLE: 1, accuracy_table("src", "tgt"): 2}
    assert {n: sink.read(spark, n).count() for n in one} == one  # nothing of the failed run shows
    for _ in range(2):  # run again, and once more than needed
        write(pair, sink, run_id="day-2")
    assert {n: sink.read(spark, n).count() for n in one} == {n: 2 * c for n, c in one.items()}
    assert sink.read(spark, PROFILE_TABLE).columns == ["database", "table", "column_name", "value", "count"]


def test_run_ids_are_names(spark, pair, tmp_path):
    with pytest.raises(ValueError, match="run id"):
        write(pair, PathSink(str(tmp_path)), run_id="../elsewhere")
    for run_id in ("007", "1e5", "2024-03-10"):  # ids that could be read as numbers or dates
        write(pair, PathSink(str(tmp_path)), run_id=run_id)
    assert PathSink(str(tmp_path)).read(spark, PROFILE_TABLE).count() == 3


def test_nothing_is_written_when_results_clash(spark, tmp_path):
    text = PAIR + PAIR.replace("dq_one", "dq_two").replace("target_cols: v", "target_cols: w")
    src = spark.createDataFrame([(1, 1.0)], "k int, v double")
    result = run(_sections(text), MappedTables({"src": src, "tgt": src.withColumn("w", src["v"])}))

    class Plain:
        names = []

        def append(self, df, name):
            self.names.append(name)

    with pytest.raises(ValueError, match="dq_one.*dq_two"):
        write(result, Plain())
    assert Plain.names == []
    # same names, other types
    other = spark.createDataFrame([(1, 1)], "k int, v int")
    both = _sections(PAIR + PAIR.replace("dq_one", "dq_two").replace("{table: ", "{database: b, table: "))
    result = run(both, MappedTables({"b.src": other, "b.tgt": other, "src": src, "tgt": src}), measures=("accuracy",))
    with pytest.raises(ValueError, match="types"):
        result.accuracy_tables()


def test_a_sink_with_append_alone_gets_every_table(spark, pair):
    class Plain:
        def __init__(self):
            self.names = []

        def append(self, df, name):
            self.names.append(name)

    sink = Plain()
    write(pair, sink, completeness_table="elsewhere")
    assert sink.names == ["elsewhere", PROFILE_TABLE, accuracy_table("src", "tgt")]


# -- reach ----------------------------------------------------------------------------


def test_staged_tables_hold_the_columns_that_are_read(spark):
    text = """
dq_x:
  source: {table: src}
  target: {table: tgt}
  lookups: {others: {table: other}}
  measure:
    timeliness: {date_column: DAY}
    completeness: {date_column: checked, date_checked: "days:-1", dq_rules: {Site: "site IN (SELECT y FROM others WHERE y <> LAC)"}}
    accuracy:
      source_filter: {groupby: "k", additional_filter: "flag > 0"}
      target_filter: {groupby: "K2"}
      dq_rules: {m: {source_cols: v, target_cols: W}}
"""
    src = spark.createDataFrame([(1, 2, 3, 4)], "k int, V int, flag int, unused int")
    tgt = spark.createDataFrame([(1, 1, "2024-01-01", "2024-01-01", 1, 2, 9)],
                                "Site int, lac int, day string, Checked string, k2 int, w int, unused int")
    staged = {}
    keep = runner.stage
    try:
        runner.stage = lambda df, s, name: staged.setdefault(name, keep(df, s, name))
        result = run(_sections(text), MappedTables({"src": src, "tgt": tgt, "other": spark.createDataFrame([(1,)], "y int")}),
                     as_of="2024-01-02", measures=runner.MEASURES[:2] + ("reconciliation",), stage_inputs=True, spark=spark,
                     extensions="all")
    finally:
        runner.stage = keep
    assert staged["None.src"].columns == ["k", "V", "flag"]
    assert staged["None.tgt"].columns == ["Site", "lac", "day", "Checked", "k2", "w"]
    assert result.completeness.first()["count_valid"] == 0  # 1 IN (no other than 1) is false
    assert [r["m_check"] for r in result.reconciliation[0][2].collect()] == [True]


def test_label_and_unknown_names(spark):
    df = spark.createDataFrame([(None,)], "k int")
    result = run(_sections("dq_x: {target: {table: t}, measure: {completeness: {dq_rules: {k: 'k IS NOT NULL'}}}}"),
                 MappedTables({"t": df}), label="NULL Value")
    assert result.profile.first()["value"] == "NULL Value"
    for options in ({"measures": ("acuracy",)}, {"extensions": ("join",)}):
        with pytest.raises(ValueError, match="unknown"):
            run([], MappedTables({}), **options)


def test_declared_keys_have_no_effect_unless_asked_for(spark):
    sections = [s for s in load_catalogs(E.CATALOGS) if s.name in ("dq_orders_day", "dq_events")]
    resolver = E._resolver(spark, SF_SMALL)
    result = run(sections, resolver, as_of=E.AS_OF)
    assert {r["count_data"] for r in result.completeness.collect()} == {1500}
    assert result.availability is None and result.timeliness.count() == 1
