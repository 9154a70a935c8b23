import os

import pytest
import yaml

from tests.conftest import SITE_RULES
from vigil.plans.catalog import load_catalogs, parse_catalog
from vigil.plans.runner import run, write
from vigil.sources.sinks import COMPLETENESS_TABLE, PathSink, accuracy_table
from vigil.sources.tables import MappedTables

CATALOG = """
_conn: &conn
  type: mariadb
  credentials_key: stage
  read_conf:
    options:
      fetch_size: 1000

dq_sites:
  target:
    <<: *conn
    database: ods
    table: sites
  measure:
    timeliness:
      date_column: last_sync
      date_format: "%Y-%m-%d"
      expected_delivery: "days:-1"
    completeness:
      date_checked: "days:-1"
      dq_rules: {}

dq_pair:
  source:
    <<: *conn
    database: stage
    table: src
  target:
    <<: *conn
    database: ods
    table: tgt
  measure:
    accuracy:
      source_filter:
        groupby: lac, ci
      join_type: inner
      dq_rules:
        max_of_lon: {source_cols: lon, target_cols: lon, aggfunc: max, threshold: 0.02}
"""


def _config():
    cfg = yaml.safe_load(CATALOG)
    cfg["dq_sites"]["measure"]["completeness"]["dq_rules"] = dict(SITE_RULES)
    return cfg


def test_parse_sections():
    secs = parse_catalog(_config())
    assert [s.name for s in secs] == ["dq_sites", "dq_pair"]
    sites, pair = secs
    assert sites.source is None and sites.target.qualified == "ods.sites"
    assert sites.target.options["read_conf"]["options"]["fetch_size"] == 1000  # merged anchor
    assert sites.timeliness.offset_days == -1
    assert [r.name for r in sites.completeness] == list(SITE_RULES)
    assert pair.accuracy.keys == ["lac", "ci"]
    assert pair.accuracy.rules[0].threshold == 0.02 and pair.accuracy.rules[0].aggfunc == "max"


def test_folder_takes_only_yml(tmp_path):
    (tmp_path / "b.yml").write_text(yaml.safe_dump({"dq_b": {"target": {"table": "t"}, "measure": {}}}))
    (tmp_path / "a.yml").write_text(yaml.safe_dump({"dq_a": {"target": {"table": "t"}, "measure": {}}}))
    (tmp_path / "c.yml.old").write_text(yaml.safe_dump({"dq_c": {"target": {"table": "t"}, "measure": {}}}))
    assert [s.name for s in load_catalogs(str(tmp_path))] == ["dq_a", "dq_b"]


def test_unknown_aggfunc_rejected():
    cfg = _config()
    cfg["dq_pair"]["measure"]["accuracy"]["dq_rules"]["max_of_lon"]["aggfunc"] = "avg"
    with pytest.raises(ValueError):
        parse_catalog(cfg)


def test_run_and_write(spark, sites, tmp_path):
    schema = "lac int, ci int, lon double"
    src = spark.createDataFrame([(1, 1, 1.0), (1, 1, 2.0), (2, 2, 3.0)], schema)
    tgt = spark.createDataFrame([(1, 1, 2.5), (2, 2, 1.0)], schema)
    res = run(
        parse_catalog(_config()),
        MappedTables({"ods.sites": sites, "stage.src": src, "ods.tgt": tgt}),
        as_of="2024-03-10",
    )
    card = res.completeness.collect()
    assert len(card) == len(SITE_RULES)  # dq_pair has no completeness rules
    assert res.timeliness.collect()[0]["timeliness_pct"] == 50.0
    name = accuracy_table("src", "tgt")
    assert set(res.accuracy_tables()) == {name}
    sink = PathSink(str(tmp_path / "results"))
    write(res, sink)
    write(res, sink)  # append
    assert sink.read(spark, COMPLETENESS_TABLE).count() == 2 * len(SITE_RULES)
    assert sink.read(spark, name).count() == 2 * 3


def test_measure_on_source_side(spark, sites):
    cfg = _config()
    cfg["dq_pair"]["measure"]["completeness"] = {"dq_rules": {"lon": "lon < 2"}}
    schema = "lac int, ci int, lon double"
    src = spark.createDataFrame([(1, 1, 1.0), (1, 1, 2.0)], schema)
    tgt = spark.createDataFrame([(1, 1, 2.5)], schema)
    res = run(parse_catalog(cfg), MappedTables({"ods.sites": sites, "stage.src": src, "ods.tgt": tgt}),
              side="source", measures=("completeness",))
    rows = res.completeness.collect()  # dq_sites has no source: no rows from it
    assert [(r["table"], r["count_data"], r["count_valid"]) for r in rows] == [("src", 2, 1)]


def test_staged_inputs_are_read_from_the_shared_folder(spark, sites):
    res = run(
        parse_catalog(_config()),
        MappedTables({"ods.sites": sites, "stage.src": sites, "ods.tgt": sites}),
        as_of="2024-03-10",
        measures=("completeness",),
        stage_inputs=True,
        spark=spark,
    )
    files = res.completeness.inputFiles()
    assert files and all("vigil-staged" in f for f in files)  # the scorecard reads the staged copy
    assert len(res.completeness.collect()) == len(SITE_RULES)


def test_jdbc_resolver_is_staged_by_default(spark, monkeypatch):
    from vigil.plans import runner
    from vigil.sources.tables import JdbcTables

    staged = []
    monkeypatch.setattr(runner, "stage", lambda df, s, name: staged.append(name) or df)
    sites_df = spark.createDataFrame([("a",)], "site_id string")

    class FakeJdbc(JdbcTables):  # no database here: hand back a DataFrame
        def __call__(self, ref):
            return sites_df

    cfg = {"dq_x": {"target": {"database": "ods", "table": "t"},
                    "measure": {"completeness": {"dq_rules": {"site_id": "site_id IS NOT NULL"}}}}}
    res = run(parse_catalog(cfg), FakeJdbc(spark, "jdbc:none:{database}"))
    assert staged == ["ods.t"]
    assert res.completeness.first()["count_valid"] == 1


def test_empty_section_and_empty_file():
    assert parse_catalog(None) == []
    (sec,) = parse_catalog({"dq_empty": None, "_anchor": {"x": 1}})
    assert sec.name == "dq_empty" and sec.target is None and sec.completeness == []


def test_sections_that_share_a_result_table(spark, tmp_path):
    import copy
    import dataclasses

    import pytest

    config = _config()
    pair = config["dq_pair"]
    again = copy.deepcopy(pair)
    schema = "lac int, ci int, lon double"
    one = spark.createDataFrame([(1, 1, 1.0)], schema)
    two = spark.createDataFrame([(2, 2, 5.0), (3, 3, 1.0)], schema)
    sections = parse_catalog({"dq_pair": pair, "dq_again": again})
    other = sections[1]
    move = lambda ref: dataclasses.replace(ref, database="elsewhere")
    sections[1] = dataclasses.replace(other, source=move(other.source), target=move(other.target))
    tables = {"stage.src": one, "ods.tgt": one, "elsewhere.src": two, "elsewhere.tgt": two}
    res = run(sections, MappedTables(tables), measures=("accuracy",))
    sink = PathSink(str(tmp_path / "both"))
    write(res, sink)
    assert sorted(r["lac"] for r in sink.read(spark, accuracy_table("src", "tgt")).collect()) == [1, 2, 3]
    res.accuracy[1] = (*res.accuracy[1][:2], res.accuracy[1][2].withColumn("extra", res.accuracy[1][2]["lac"]))
    with pytest.raises(ValueError, match="dq_pair.*dq_again"):
        res.accuracy_tables()


def test_counts_and_profile_as_two_tables(spark, sites, tmp_path):
    sections = [s for s in parse_catalog(_config()) if s.completeness]
    res = run(sections, MappedTables({"ods.sites": sites}), measures=("completeness",), invalid=None,
              profile=True)
    sink = PathSink(str(tmp_path / "two"))
    write(res, sink)
    assert "data_invalid" not in sink.read(spark, COMPLETENESS_TABLE).columns
    rows = sink.read(spark, "completeness_profile").collect()
    assert {(r["database"], r["table"]) for r in rows} == {("ods", "sites")}
    assert ("site_name", "NULL", 1) in {(r["column_name"], r["value"], r["count"]) for r in rows}
