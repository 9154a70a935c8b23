"""

``entry(spark)`` runs the flagship query (the completeness scorecard) on
``(spark, sf_dir) -> DataFrame`` callable built with the ``vigil`` package;
``oracle_sql()`` gives the same result as DuckDB SQL over the driver's views.

The test tables carry no NULLs, so the inputs derive some with NULLIF - the
same text in Spark and DuckDB:

* ``B`` - orders with ``status`` (NULL for 'P') and ``prio`` (NULL for '5-LOW');
* ``S`` - lineitem as an accuracy source (k1, k2, price, qty);
* ``T`` - lineitem with line 7 under other keys (so either side has keys that the
  other lacks), line-3 prices and line-5 quantities lowered by 1, as the accuracy
  target.

Not registered (see README): ``literal_rows`` reads no table, and
``jdbc_roundtrip`` would need a database.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HERE = os.path.dirname(os.path.abspath(__file__))
if HERE not in sys.path:  # the package sits next to this file
    sys.path.insert(0, HERE)

from vigil.functions.rules import Rule, listed_in  # noqa: E402
from vigil.operators import accuracy as acc  # noqa: E402
from vigil.operators import completeness as comp  # noqa: E402
from vigil.operators.availability import availability  # noqa: E402
from vigil.operators.timeliness import on_time_rows, timeliness  # noqa: E402
from vigil.plans.catalog import load_catalog, load_catalogs  # noqa: E402
from vigil.plans.runner import PROFILE_TABLE, reconciliation_table, run, write  # noqa: E402
from vigil.sources.sinks import COMPLETENESS_TABLE, PathSink, accuracy_table, shared_dir  # noqa: E402
from vigil.sources.tables import MappedTables  # noqa: E402

CATALOGS = os.path.join(HERE, "catalogs")
CATALOG = os.path.join(CATALOGS, "tpch_example.yml")
AS_OF = "1998-10-04"
AS_OF_EVENTS = "2024-02-02"
PART_BYTES = 4096

# The derived inputs, written once and used by both sides.
B_COLS = [
    "o_orderkey",
    "nullif(o_orderstatus, 'P') AS status",
    "nullif(o_orderpriority, '5-LOW') AS prio",
    "o_totalprice",
    "o_orderpriority",
    "o_orderdate",
]
S_COLS = ["l_partkey AS k1", "l_suppkey AS k2", "l_extendedprice AS price", "l_quantity AS qty"]
T_COLS = [
    "CASE WHEN l_linenumber = 7 THEN -l_partkey ELSE l_partkey END AS k1",
    "l_suppkey AS k2",
    "CASE WHEN l_linenumber = 3 THEN l_extendedprice - 1 ELSE l_extendedprice END AS price",
    "CASE WHEN l_linenumber = 5 THEN l_quantity - 1 ELSE l_quantity END AS qty",
]

# Completeness rules on B - (rule key = column, Spark predicate, DuckDB predicate).
ORDER_RULES = [
    ("status", "status IS NOT NULL", "status IS NOT NULL"),
    ("prio", "prio LIKE '1%'", "prio LIKE '1%'"),
    (
        "o_orderpriority",
        "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
        "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
    ),
    ("o_totalprice", "o_totalprice BETWEEN 1000 AND 400000", "o_totalprice BETWEEN 1000 AND 400000"),
    (
        "o_orderkey",
        "cast(o_orderkey as string) RLIKE '^([0-9]{1,4})$'",
        "regexp_matches(cast(o_orderkey as varchar), '^([0-9]{1,4})$')",
    ),
]
# The customer section of catalogs/tpch_example.yml, DuckDB spelling.
CUSTOMER_RULES_DUCK = [
    ("c_mktsegment", "c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')"),
    ("c_acctbal", "c_acctbal BETWEEN 0 AND 9000"),
    ("c_name", "(c_name IS NOT NULL AND regexp_matches(c_name, '#0000000[0-9]'))"),
]
# Rules with subqueries on customers - (rule, column, Spark predicate, DuckDB predicate).
C_COLS = ["c_custkey", "nullif(c_nationkey, 5) AS nation", "c_mktsegment", "c_acctbal"]
_IN_REGION = "nation IN (SELECT n_nationkey FROM {nation} WHERE n_regionkey < 3)"
_NOT_IN = "nation NOT IN (SELECT nullif(n_nationkey, 3) FROM {nation} WHERE n_regionkey = 1)"
_ORDERED = "EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_totalprice > 300000)"
_HALF = "c_acctbal <= (SELECT max(c_acctbal) / 2 FROM {customer})"
_SEGMENTS = "SELECT nullif(c_mktsegment, 'HOUSEHOLD') FROM {customer} WHERE c_mktsegment <> 'MACHINERY'"
_KEYS = "SELECT o_custkey FROM {orders} WHERE o_orderkey % 3 = 0"


def _subquery_rules(spark: bool) -> list[tuple[str, str, str]]:
    names = {t: f"vigil_{t}" if spark else t for t in ("nation", "orders", "customer")}
    listed = lambda c, q: listed_in(c, q.format(**names)) if spark else f"{c} IN ({q.format(**names)})"
    return [
        ("in_region", "nation", _IN_REGION.format(**names)),
        ("not_in", "nation", _NOT_IN.format(**names)),
        ("ordered", "c_custkey", _ORDERED.format(**names)),
        ("half", "c_acctbal", _HALF.format(**names)),
        ("segment", "c_mktsegment", listed("c_mktsegment", _SEGMENTS)),
        ("key", "c_custkey", listed("c_custkey", _KEYS)),
    ]


# ---------------------------------------------------------------------------
# inputs


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_b(spark, sf_dir):
    return _read(spark, sf_dir, "orders").selectExpr(*B_COLS)


def table_s(spark, sf_dir, lineitem=None):
    li = lineitem if lineitem is not None else _read(spark, sf_dir, "lineitem")
    return li.selectExpr(*S_COLS)


def table_t(spark, sf_dir, lineitem=None):
    li = lineitem if lineitem is not None else _read(spark, sf_dir, "lineitem")
    return li.selectExpr(*T_COLS)


def tables_st(spark, sf_dir):
    """S and T over one read of lineitem (one file listing, one footer read)."""
    li = _read(spark, sf_dir, "lineitem")
    return table_s(spark, sf_dir, li), table_t(spark, sf_dir, li)


def table_st(spark, sf_dir):
    """The keys and prices of S and T from one scan of lineitem; ``of_source`` tells S's rows."""
    sides = (("true", S_COLS), ("false", T_COLS))
    rows = ", ".join(f"struct({flag} AS of_source, {', '.join(cols[:3])})" for flag, cols in sides)
    return _read(spark, sf_dir, "lineitem").selectExpr(f"inline(array({rows}))")


def _order_rules() -> list[Rule]:
    return [Rule(name, pred) for name, pred, _ in ORDER_RULES]


def _resolver(spark, sf_dir) -> MappedTables:
    pair = []

    def st():
        if not pair:
            pair.extend(tables_st(spark, sf_dir))
        return pair

    return MappedTables(
        {
            "tpch.orders_b": lambda: table_b(spark, sf_dir),
            "tpch.customer": lambda: _read(spark, sf_dir, "customer"),
            "tpch.lineitem_s": lambda: st()[0],
            "tpch.lineitem_t": lambda: st()[1],
            "tpch.events": lambda: _read(spark, sf_dir, "events"),
            "tpch.nation": lambda: _read(spark, sf_dir, "nation"),
            "tpch.orders": lambda: _read(spark, sf_dir, "orders"),
            "tpch.lineitem_day_s": lambda: _read(spark, sf_dir, "lineitem").selectExpr(*S_COLS, "l_shipdate AS shipped"),
            "tpch.lineitem_day_t": lambda: (
                _read(spark, sf_dir, "lineitem").selectExpr(*T_COLS, "l_shipdate AS shipped")
                .withColumnsRenamed({"k1": "part", "k2": "supp"})
            ),
            "other.lineitem_s": lambda: st()[0].where("qty > 25"),
            "other.lineitem_t": lambda: st()[1].where("qty > 25"),
        }
    )


PRICE_MAX = acc.AccuracyRule("max_of_price", "price", "price", "max", 0.02)
QTY_SUM = acc.AccuracyRule("sum_of_qty", "qty", "qty", "sum", 0)
QTY_MAX = acc.AccuracyRule("max_of_qty", "qty", "qty", "max", 0)
KEYS = "k1,k2"


# ---------------------------------------------------------------------------
# queries


def q_completeness_scorecard(spark, sf_dir):
    return comp.scorecard(table_b(spark, sf_dir), _order_rules(), "tpch", "orders_b")


def q_invalid_value_profile(spark, sf_dir):
    return comp.invalid_value_profile(table_b(spark, sf_dir), _order_rules())


def q_invalid_profile_json(spark, sf_dir):
    return comp.invalid_profile_json(table_b(spark, sf_dir), _order_rules())


def q_invalid_distinct_values(spark, sf_dir):
    return comp.invalid_distinct_values(table_b(spark, sf_dir), _order_rules())


def q_completeness_rate(spark, sf_dir):
    return comp.completeness_rate(table_b(spark, sf_dir), _order_rules())


def q_timeliness_pct(spark, sf_dir):
    return timeliness(table_b(spark, sf_dir), "o_orderdate", "days:-1", AS_OF, "tpch", "orders_b")


def q_expected_date(spark, sf_dir):
    """The expected delivery date of a timeliness measure, with the rows it was measured on."""
    return timeliness(table_b(spark, sf_dir), "o_orderdate", "days:-1", AS_OF, "tpch", "orders_b").select(
        "date_column", "expected_date", "count_data"
    )


def q_accuracy_rule_check(spark, sf_dir):
    return acc.rule_check(*tables_st(spark, sf_dir), KEYS, PRICE_MAX)


def q_accuracy_multi_agg(spark, sf_dir):
    return acc.reconcile(*tables_st(spark, sf_dir), KEYS, [PRICE_MAX, QTY_MAX])


def q_accuracy_report(spark, sf_dir):
    return acc.accuracy_report(*tables_st(spark, sf_dir), KEYS, [PRICE_MAX, QTY_SUM])


def _catalog_run(spark, sf_dir, *measures):
    return run(load_catalog(CATALOG), _resolver(spark, sf_dir), as_of=AS_OF, measures=measures, invalid="json")


def _customers(spark, sf_dir):
    """Customers, with the tables that subqueries name as views."""
    for t in ("nation", "orders", "customer"):
        _read(spark, sf_dir, t).createOrReplaceTempView(f"vigil_{t}")
    return _read(spark, sf_dir, "customer").selectExpr(*C_COLS), [Rule(n, p, c) for n, c, p in _subquery_rules(True)]


def q_rule_subquery(spark, sf_dir):
    """The scorecard of rules that look into other tables."""
    return comp.scorecard(*_customers(spark, sf_dir), "tpch", "customer")


def q_rule_subquery_profile(spark, sf_dir):
    return comp.invalid_value_profile(*_customers(spark, sf_dir))


def q_rule_subquery_rate(spark, sf_dir):
    return comp.completeness_rate(*_customers(spark, sf_dir))


def q_invalid_profile_parts(spark, sf_dir):
    """The failing values of each rule as JSON text, in parts of bounded size."""
    return comp.invalid_profile_parts(table_b(spark, sf_dir), _order_rules(), part_bytes=PART_BYTES)


def _folder_run(spark, sf_dir, *measures, **options):
    """Every section of every catalog of the folder."""
    return run(load_catalogs(CATALOGS), _resolver(spark, sf_dir), as_of=AS_OF, measures=measures, **options)


def q_folder_counts(spark, sf_dir):
    """The batch's default: counts alone, from one scan that also gives the failing values."""
    return _folder_run(spark, sf_dir, "completeness").completeness


def q_folder_profile_sink(spark, sf_dir):
    """The failing values, written by a run that is repeated with its id."""
    sink, run_id = _fresh_sink(spark), uuid.uuid4().hex
    result = _folder_run(spark, sf_dir, "completeness")
    write(result, sink, run_id=run_id)
    write(result, sink, run_id=run_id)
    return sink.read(spark, PROFILE_TABLE)


def q_folder_timeliness(spark, sf_dir):
    return _folder_run(spark, sf_dir, "timeliness").timeliness


def q_folder_rate(spark, sf_dir):
    return _folder_run(spark, sf_dir, "rate").rate


def q_folder_accuracy_sink(spark, sf_dir):
    """Two sections whose reports share a result table."""
    sink, name = _fresh_sink(spark), accuracy_table("lineitem_s", "lineitem_t")
    sections = [s for s in load_catalogs(CATALOGS) if s.accuracy and s.source.table == "lineitem_s"]
    write(run(sections, _resolver(spark, sf_dir), as_of=AS_OF, measures=("accuracy",)), sink)
    return sink.read(spark, name)


def q_folder_reconciliation(spark, sf_dir):
    """One row per key, from the batch, for the two sections that share a result table."""
    sections = [s for s in load_catalogs(CATALOGS) if s.accuracy and s.source.table == "lineitem_s"]
    result = run(sections, _resolver(spark, sf_dir), as_of=AS_OF, measures=("reconciliation",))
    return result.tables()[reconciliation_table("lineitem_s", "lineitem_t")]


def q_checked_day_counts(spark, sf_dir):
    """Completeness of one day's rows."""
    sections = [s for s in load_catalogs(CATALOGS) if s.name == "dq_orders_day"]
    options = {"measures": ("completeness",), "extensions": ("date_checked",), "profile": False}
    return run(sections, _resolver(spark, sf_dir), as_of=AS_OF, **options).completeness


def q_checked_day_reconciliation(spark, sf_dir):
    """One day of both sides, keys named differently, all keys of either side."""
    sections = [s for s in load_catalogs(CATALOGS) if s.name == "dq_lineitem_day"]
    result = run(sections, _resolver(spark, sf_dir), as_of=AS_OF, measures=("reconciliation",), extensions="all")
    return result.tables()[reconciliation_table("lineitem_day_s", "lineitem_day_t")]


def q_reconcile_outer(spark, sf_dir):
    """Every key of either side, marked with the sides that have it."""
    return acc.reconcile_outer(*tables_st(spark, sf_dir), KEYS, [PRICE_MAX, QTY_SUM])


def q_availability(spark, sf_dir):
    """The days before the run date, with the rows of each and those that have none."""
    return availability(_read(spark, sf_dir, "events"), "ts", "days:-8", "days:-1", "days", AS_OF_EVENTS, "tpch", "events")


def q_availability_hours(spark, sf_dir):
    sections = [s for s in load_catalogs(CATALOGS) if s.name == "dq_events"]
    events = _resolver(spark, sf_dir)(sections[0].target)
    return availability(events, "ts", -5, -2, "hours", AS_OF_EVENTS, "tpch", "events")


def q_folder_availability(spark, sf_dir):
    """Availability from the batch, for sections that declare a span."""
    resolver = _resolver(spark, sf_dir)
    return run(load_catalogs(CATALOGS), resolver, as_of=AS_OF_EVENTS, measures=("availability",)).availability


def q_multi_section_scorecard(spark, sf_dir):
    return _catalog_run(spark, sf_dir, "completeness").completeness


def q_multi_section_counts(spark, sf_dir):
    """The scorecard's counts alone."""
    run_ = run(load_catalog(CATALOG), _resolver(spark, sf_dir), as_of=AS_OF, measures=("completeness",), invalid=None)
    return run_.completeness


def q_multi_section_profile(spark, sf_dir):
    """The failing values of all sections, as rows."""
    return run(load_catalog(CATALOG), _resolver(spark, sf_dir), as_of=AS_OF, measures=("completeness",), invalid=None,
               profile=True).profile


def q_on_time_rows(spark, sf_dir):
    return on_time_rows(table_b(spark, sf_dir), "o_orderdate", "days:-1", AS_OF).select("o_orderkey", "o_orderdate")


def q_multi_section_timeliness(spark, sf_dir):
    return _catalog_run(spark, sf_dir, "timeliness").timeliness


def _fresh_sink(spark) -> PathSink:
    return PathSink(os.path.join(shared_dir(spark), "vigil-results", uuid.uuid4().hex))


def q_completeness_sink(spark, sf_dir):
    sink = _fresh_sink(spark)
    sink.append(_catalog_run(spark, sf_dir, "completeness").completeness, COMPLETENESS_TABLE)
    return sink.read(spark, COMPLETENESS_TABLE)


def q_accuracy_sink(spark, sf_dir):
    sink = _fresh_sink(spark)
    name = accuracy_table("lineitem_s", "lineitem_t")
    sink.append(_catalog_run(spark, sf_dir, "accuracy").accuracy_tables()[name], name)
    return sink.read(spark, name)


def q_filter_gt(spark, sf_dir):
    return table_b(spark, sf_dir).filter(F.col("o_totalprice") > 400000).select("o_orderkey", "o_totalprice")


def _violating(rule: str, *cols, text_form=False):
    def q(spark, sf_dir):
        return comp.violations(table_b(spark, sf_dir), rule, text_form=text_form).select(*cols)

    return q


def q_project_sort_desc(spark, sf_dir):
    return table_b(spark, sf_dir).select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc(), F.col("o_orderkey")
    )


def q_rule_flag(spark, sf_dir):
    return comp.rule_flags(table_b(spark, sf_dir), [Rule("prio", "prio LIKE '1%'")], keep=["o_orderkey"])


def q_null_label(spark, sf_dir):
    return comp.label_nulls(table_b(spark, sf_dir).select("o_orderkey", "prio"), ["prio"])


def q_row_count(spark, sf_dir):
    return comp.row_count(table_b(spark, sf_dir))


def q_violation_count(spark, sf_dir):
    return comp.violation_count(table_b(spark, sf_dir), "prio LIKE '1%'")


def q_pass_percentage(spark, sf_dir):
    return comp.pass_percentage(table_b(spark, sf_dir), "prio LIKE '1%'")


def q_group_count_desc(spark, sf_dir):
    return comp.group_count_desc(table_b(spark, sf_dir), "prio")


def q_distinct_values(spark, sf_dir):
    bad = comp.violations(table_b(spark, sf_dir), "prio IS NOT NULL AND prio LIKE '1%'")
    return comp.distinct_values(bad, "prio")


def q_group_max(spark, sf_dir):
    return acc.side_aggregates(table_s(spark, sf_dir), KEYS, [PRICE_MAX], "source")


def q_group_sum(spark, sf_dir):
    return acc.side_aggregates(table_s(spark, sf_dir), KEYS, [QTY_SUM], "source")


def q_group_multi_agg(spark, sf_dir):
    return acc.side_aggregates(table_s(spark, sf_dir), KEYS, [PRICE_MAX, QTY_MAX, QTY_SUM], "source")


def q_inner_join_keys(spark, sf_dir):
    s_in, t_in = tables_st(spark, sf_dir)
    s = acc.side_aggregates(s_in, KEYS, [PRICE_MAX], "source")
    t = acc.side_aggregates(t_in, KEYS, [PRICE_MAX], "target")
    return s.join(t, ["k1", "k2"], "inner")


def q_outer_join_keys(spark, sf_dir):
    """Source key rows full-outer-joined to the per-key check (USING the keys), without shuffling
    the key rows themselves: keys of one side alone appear on either side."""
    check = acc.target_check(table_st(spark, sf_dir), KEYS, PRICE_MAX, "of_source")
    return acc.join_key_rows(table_s(spark, sf_dir).select("k1", "k2"), check, KEYS, "full_outer")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the completeness scorecard of ``B`` on sf0.001."""
    return q_completeness_scorecard(spark, "/root/testdata/sf0.001")


def _llm():
    """The training-data operators' query module, or None where ``vigil.llm`` and
    ``corpus_pipeline.py`` are not installed.  Any other import error is raised."""
    try:
        from vigil.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name in ("corpus_pipeline", "vigil.llm") or (e.name or "").startswith("vigil.llm."):
            return None
        raise
    except ImportError as e:  # an emptied folder is still a namespace package
        if e.name == "vigil.llm":
            return None
        raise
    return llm


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    return core_queries() | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    llm = _llm()
    return core_oracle_sql() | (llm.oracle_sql() if llm else {})


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "completeness_scorecard": q_completeness_scorecard,
        "invalid_value_profile": q_invalid_value_profile,
        "invalid_profile_json": q_invalid_profile_json,
        "invalid_distinct_values": q_invalid_distinct_values,
        "completeness_rate": q_completeness_rate,
        "timeliness_pct": q_timeliness_pct,
        "expected_date": q_expected_date,
        "accuracy_rule_check": q_accuracy_rule_check,
        "accuracy_multi_agg": q_accuracy_multi_agg,
        "accuracy_report": q_accuracy_report,
        "multi_section_scorecard": q_multi_section_scorecard,
        "multi_section_counts": q_multi_section_counts,
        "multi_section_profile": q_multi_section_profile,
        "on_time_rows": q_on_time_rows,
        "multi_section_timeliness": q_multi_section_timeliness,
        "completeness_sink": q_completeness_sink,
        "accuracy_sink": q_accuracy_sink,
        "filter_gt": q_filter_gt,
        "rule_violations": _violating("prio LIKE '1%'", "o_orderkey", "prio", text_form=True),
        "rule_violations_expr": _violating("status IN ('F')", "o_orderkey", "status"),
        "rule_not_null": _violating("status IS NOT NULL", "o_orderkey"),
        "rule_like": _violating("prio LIKE '%HIGH'", "o_orderkey", "prio"),
        "rule_in_list": _violating(
            "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')", "o_orderkey", "o_orderpriority"
        ),
        "rule_regex_find": _violating("prio RLIKE '([1-3])-'", "o_orderkey", "prio"),
        "rule_regex_full": _violating("cast(o_orderkey as string) RLIKE '^([0-9]{1,4})$'", "o_orderkey"),
        "rule_between": _violating("o_totalprice BETWEEN 1000 AND 400000", "o_orderkey", "o_totalprice"),
        "rule_compound": _violating("(prio IS NOT NULL AND prio RLIKE '([1-3])-')", "o_orderkey", "prio"),
        "project_sort_desc": q_project_sort_desc,
        "rule_flag": q_rule_flag,
        "null_label": q_null_label,
        "row_count": q_row_count,
        "violation_count": q_violation_count,
        "pass_percentage": q_pass_percentage,
        "group_count_desc": q_group_count_desc,
        "distinct_values": q_distinct_values,
        "group_max": q_group_max,
        "group_sum": q_group_sum,
        "group_multi_agg": q_group_multi_agg,
        "inner_join_keys": q_inner_join_keys,
        "outer_join_keys": q_outer_join_keys,
        "rule_subquery": q_rule_subquery,
        "rule_subquery_profile": q_rule_subquery_profile,
        "rule_subquery_rate": q_rule_subquery_rate,
        "invalid_profile_parts": q_invalid_profile_parts,
        "folder_counts": q_folder_counts,
        "folder_profile_sink": q_folder_profile_sink,
        "folder_timeliness": q_folder_timeliness,
        "folder_rate": q_folder_rate,
        "folder_accuracy_sink": q_folder_accuracy_sink,
        "folder_reconciliation": q_folder_reconciliation,
        "folder_availability": q_folder_availability,
        "checked_day_counts": q_checked_day_counts,
        "checked_day_reconciliation": q_checked_day_reconciliation,
        "reconcile_outer": q_reconcile_outer,
        "availability": q_availability,
        "availability_hours": q_availability_hours,
    }


# ---------------------------------------------------------------------------
# DuckDB oracle

_B = f"(SELECT {', '.join(B_COLS)} FROM orders)"
_S = f"(SELECT {', '.join(S_COLS)} FROM lineitem)"
_T = f"(SELECT {', '.join(T_COLS)} FROM lineitem)"
_C = f"(SELECT {', '.join(C_COLS)} FROM customer)"
_DAY = "DATE '1998-10-03'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _json_profile_sql(src: str, column: str, pred: str) -> str:
    return (
        "SELECT CAST(to_json(list({'value': value, 'count': cnt} ORDER BY cnt DESC, value)) AS VARCHAR) AS j "
        f"FROM (SELECT coalesce(CAST({column} AS VARCHAR), 'NULL') AS value, count(*) AS cnt "
        f"FROM {src} WHERE NOT ({pred}) GROUP BY 1)"
    )


def _scorecard_sql(src: str, db: str, table: str, rules: list[tuple[str, str]]) -> str:
    parts = []
    for name, pred in rules:
        parts.append(
            f"SELECT {_q(db)} AS \"database\", {_q(table)} AS \"table\", {_q(name)} AS \"column\", "
            "c.n AS count_data, c.n - c.bad AS count_valid, "
            "CASE WHEN c.n > 0 THEN (c.n - c.bad) / c.n * 100 ELSE 0.0 END AS percentage_valid, "
            "coalesce(p.j, '[]') AS data_invalid "
            f"FROM (SELECT count(*) AS n, count(*) FILTER (WHERE NOT ({pred})) AS bad FROM {src}) c, "
            f"({_json_profile_sql(src, name, pred)}) p"
        )
    return "\nUNION ALL\n".join(parts)


def _order_rules_duck() -> list[tuple[str, str]]:
    return [(name, duck) for name, _, duck in ORDER_RULES]


def _price_check_sql() -> str:
    return (
        "SELECT a.k1, a.k2, p AS max_source_price, q AS max_target_price, p - q <= 0.02 AS price_accuracy "
        f"FROM (SELECT k1, k2, max(price) AS p FROM {_S} GROUP BY k1, k2) a JOIN "
        f"(SELECT k1, k2, max(price) AS q FROM {_T} GROUP BY k1, k2) b ON a.k1 = b.k1 AND a.k2 = b.k2"
    )


def _multi_section_sql() -> str:
    return (
        _scorecard_sql(_B, "tpch", "orders_b", _order_rules_duck())
        + "\nUNION ALL\n"
        + _scorecard_sql("customer", "tpch", "customer", CUSTOMER_RULES_DUCK)
    )


def _timeliness_sql() -> str:
    day = "DATE '1998-10-04' - INTERVAL 1 DAY"
    timely = f"count(*) FILTER (WHERE CAST(o_orderdate AS DATE) = CAST({day} AS DATE))"
    return (
        "SELECT 'tpch' AS \"database\", 'orders_b' AS \"table\", 'o_orderdate' AS date_column, "
        "'1998-10-03' AS expected_date, count(*) AS count_data, "
        f"{timely} AS count_timely, {timely} / nullif(count(*), 0) * 100 AS timeliness_pct FROM {_B}"
    )


def _violating_sql(pred: str, cols: str) -> str:
    return f"SELECT {cols} FROM {_B} WHERE NOT ({pred})"


def _rules_sql(src: str, rules: list[tuple[str, str, str]], head: str, shape: str) -> str:
    """``shape`` of every rule (name, column, predicate) over rows (value, bad, ok): the column's text, and
    whether the predicate is false or true."""
    parts = [
        f"SELECT {head}{shape.format(name=_q(n))} FROM (SELECT coalesce(CAST({c} AS VARCHAR), 'NULL') AS value, "
        f"coalesce(NOT ({p}), false) AS bad, coalesce({p}, false) AS ok FROM {src}) r" for n, c, p in rules
    ]
    return "\nUNION ALL\n".join(parts)


_COUNTS = (
    "{name} AS \"column\", count(*) AS count_data, count(*) - count(*) FILTER (WHERE bad) AS count_valid, "
    "CASE WHEN count(*) > 0 THEN (count(*) - count(*) FILTER (WHERE bad)) / count(*) * 100 ELSE 0.0 END AS percentage_valid"
)
_RATE = "{name} AS \"column\", count(*) FILTER (WHERE ok) / nullif(count(*), 0) AS rate"


def _profile_sql(src: str, rules, head: str = "") -> str:
    rows = [
        f"SELECT {head}{_q(n)} AS column_name, coalesce(CAST({c} AS VARCHAR), 'NULL') AS value, count(*) AS \"count\" "
        f"FROM (SELECT *, NOT ({p}) AS bad FROM {src}) r WHERE bad GROUP BY value" for n, c, p in rules
    ]
    return "\nUNION ALL\n".join(rows)


def _place(database: str, table: str) -> str:
    return f"{_q(database)} AS \"database\", {_q(table)} AS \"table\", "


def _subquery_card_sql() -> str:
    rules, texts = _subquery_rules(False), []
    for name, column, pred in rules:
        texts.append(
            f"SELECT {_q(name)} AS \"column\", coalesce((SELECT CAST(to_json(list({{'value': value, 'count': cnt}} "
            "ORDER BY cnt DESC, value)) AS VARCHAR) FROM (SELECT coalesce(CAST(" + column + " AS VARCHAR), 'NULL') AS value, "
            f"count(*) AS cnt FROM (SELECT *, NOT ({pred}) AS bad FROM {_C}) r WHERE bad GROUP BY 1)), '[]') AS data_invalid"
        )
    return (
        f"SELECT c.*, t.data_invalid FROM ({_rules_sql(_C, rules, _place('tpch', 'customer'), _COUNTS)}) c JOIN ("
        + "\nUNION ALL\n".join(texts) + ") t ON c.\"column\" = t.\"column\""
    )


def _parts_sql() -> str:
    parts = []
    for name, pred in _order_rules_duck():
        texts = (
            "SELECT value, cnt, CAST(to_json({'value': value, 'count': cnt}) AS VARCHAR) AS t FROM (SELECT "
            f"coalesce(CAST({name} AS VARCHAR), 'NULL') AS value, count(*) AS cnt FROM {_B} WHERE NOT ({pred}) GROUP BY 1)"
        )
        placed = (
            "SELECT *, sum(strlen(t) + 1) OVER w - strlen(t) - 1 AS start_at, row_number() OVER w AS no, count(*) OVER () AS n "
            f"FROM ({texts}) WINDOW w AS (ORDER BY cnt DESC, value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        )
        parts.append(
            f"SELECT {_q(name)} AS \"column\", CAST((start_at - start_at % {PART_BYTES}) / {PART_BYTES} AS BIGINT) AS part, CASE WHEN min(no) = 1 THEN '[' "
            "ELSE ',' END || string_agg(t, ',' ORDER BY cnt DESC, value) || CASE WHEN max(no) = any_value(n) THEN ']' ELSE '' "
            f"END AS text FROM ({placed}) GROUP BY 2"
        )
        parts.append(f"SELECT {_q(name)}, 0, '[]' WHERE NOT EXISTS (SELECT 1 FROM {_B} WHERE NOT ({pred}))")
    return "\nUNION ALL\n".join(parts)


def _folder_rules() -> list[tuple[str, str, list[tuple[str, str, str]]]]:
    """(table, FROM item, rules) of every completeness section of the folder."""
    three = lambda rules: [(n, n, p) for n, p in rules]
    return [
        ("orders_b", _B, three(_order_rules_duck())),
        ("customer", "customer", three(CUSTOMER_RULES_DUCK)),
        ("orders_b", _B, three(_order_rules_duck()[:2])),
        ("customer", "customer", [
            ("c_nationkey", "c_nationkey", "c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)"),
            ("has_orders", "c_custkey", "c_custkey IN (SELECT o_custkey FROM orders)"),
        ]),
    ]


def _folder_sql(shape: str) -> str:
    return "\nUNION ALL\n".join(_rules_sql(src, rules, _place("tpch", t), shape) for t, src, rules in _folder_rules())


def _report_sql(s: str, t: str) -> str:
    """The accuracy report of FROM items ``s`` and ``t``."""
    return (
        "SELECT s.k1, s.k2, j.p AS max_source_price, j.q AS max_target_price, j.p - j.q <= 0.02 AS price_accuracy, "
        "j.x AS sum_source_qty, j.y AS sum_target_qty, j.x - j.y <= 0 AS qty_accuracy "
        f"FROM {s} s LEFT JOIN (SELECT a.k1, a.k2, p, q, x, y FROM "
        f"(SELECT k1, k2, max(price) AS p, sum(qty) AS x FROM {s} GROUP BY k1, k2) a JOIN "
        f"(SELECT k1, k2, max(price) AS q, sum(qty) AS y FROM {t} GROUP BY k1, k2) b "
        "ON a.k1 = b.k1 AND a.k2 = b.k2) j ON s.k1 = j.k1 AND s.k2 = j.k2"
    )


def _reconcile_sql(s: str, t: str, how: str, presence: bool = True) -> str:
    both = "a.here AND b.here"
    mark = f"CASE WHEN {both} THEN 'both' WHEN a.here THEN 'source' ELSE 'target' END AS presence, " if presence else ""
    return (
        f"SELECT coalesce(a.k1, b.k1) AS k1, coalesce(a.k2, b.k2) AS k2, {mark}p AS max_source_price, "
        "x AS sum_source_qty, q AS max_target_price, y AS sum_target_qty, p - q <= 0.02 AS max_of_price_check, "
        "x - y <= 0 AS sum_of_qty_check FROM "
        f"(SELECT k1, k2, true AS here, max(price) AS p, sum(qty) AS x FROM {s} GROUP BY k1, k2) a {how} JOIN "
        f"(SELECT k1, k2, true AS here, max(price) AS q, sum(qty) AS y FROM {t} GROUP BY k1, k2) b "
        "ON a.k1 = b.k1 AND a.k2 = b.k2"
    )


def _availability_sql(first: str, last: str, step: str, shown: str) -> str:
    return (
        "SELECT 'tpch' AS \"database\", 'events' AS \"table\", 'ts' AS date_column, "
        f"strftime(c.at, '{shown}') AS \"interval\", count(e.at) AS count_data, count(e.at) > 0 AS available "
        f"FROM (SELECT unnest(generate_series(TIMESTAMP '{first}', TIMESTAMP '{last}', INTERVAL 1 {step})) AS at) c "
        f"LEFT JOIN (SELECT date_trunc('{step}', ts) AS at FROM events) e ON c.at = e.at GROUP BY c.at"
    )


def core_oracle_sql() -> dict[str, str]:
    rules = _order_rules_duck()
    profile = "\nUNION ALL\n".join(
        f"SELECT {_q(n)} AS column_name, coalesce(CAST({n} AS VARCHAR), 'NULL') AS value, count(*) AS \"count\" "
        f"FROM {_B} WHERE NOT ({p}) GROUP BY 2"
        for n, p in rules
    )
    json_ = "\nUNION ALL\n".join(
        f"SELECT {_q(n)} AS \"column\", coalesce(({_json_profile_sql(_B, n, p)}), '[]') AS data_invalid"
        for n, p in rules
    )
    distinct = "\nUNION ALL\n".join(
        f"SELECT {_q(n)} AS \"column\", coalesce(string_agg(value, '|' ORDER BY value), '') AS distinct_invalid "
        f"FROM (SELECT DISTINCT coalesce(CAST({n} AS VARCHAR), 'NULL') AS value FROM {_B} WHERE NOT ({p}))"
        for n, p in rules
    )
    rate = "\nUNION ALL\n".join(
        f"SELECT {_q(n)} AS \"column\", count(*) FILTER (WHERE {p}) / nullif(count(*), 0) AS rate FROM {_B}"
        for n, p in rules
    )
    multi = _multi_section_sql()
    report = _report_sql(_S, _T)
    other = [f"(SELECT * FROM {x} WHERE qty > 25)" for x in (_S, _T)]
    day = [f"(SELECT {', '.join(c)} FROM lineitem WHERE CAST(l_shipdate AS DATE) = {_DAY})" for c in (S_COLS, T_COLS)]
    hours = _availability_sql("2024-01-28 00:00:00", "2024-01-31 23:00:00", "hour", "%Y-%m-%d %H:00")
    days = _availability_sql("2024-01-25 00:00:00", "2024-02-01 00:00:00", "day", "%Y-%m-%d")
    return {
        "completeness_scorecard": _scorecard_sql(_B, "tpch", "orders_b", rules),
        "invalid_value_profile": profile,
        "invalid_profile_json": json_,
        "invalid_distinct_values": distinct,
        "completeness_rate": rate,
        "timeliness_pct": _timeliness_sql(),
        "expected_date": (
            "SELECT 'o_orderdate' AS date_column, "
            "CAST(CAST(DATE '1998-10-04' - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS expected_date, "
            f"count(*) AS count_data FROM {_B}"
        ),
        "accuracy_rule_check": _price_check_sql(),
        "accuracy_multi_agg": (
            "SELECT a.k1, a.k2, p AS max_source_price, x AS max_source_qty, q AS max_target_price, "
            "y AS max_target_qty, p - q <= 0.02 AS max_of_price_check, x - y <= 0 AS max_of_qty_check "
            f"FROM (SELECT k1, k2, max(price) AS p, max(qty) AS x FROM {_S} GROUP BY k1, k2) a JOIN "
            f"(SELECT k1, k2, max(price) AS q, max(qty) AS y FROM {_T} GROUP BY k1, k2) b "
            "ON a.k1 = b.k1 AND a.k2 = b.k2"
        ),
        "accuracy_report": report,
        "multi_section_scorecard": multi,
        "multi_section_counts": (
            'SELECT "database", "table", "column", count_data, count_valid, percentage_valid FROM (' + multi + ")"
        ),
        "multi_section_profile": (
            "SELECT 'tpch' AS \"database\", 'orders_b' AS \"table\", * FROM (" + profile + ") UNION ALL "
            "SELECT 'tpch', 'customer', * FROM (" + "\nUNION ALL\n".join(
                f"SELECT {_q(n)} AS column_name, coalesce(CAST({n} AS VARCHAR), 'NULL') AS value, count(*) AS \"count\" "
                f"FROM customer WHERE NOT ({p}) GROUP BY 2" for n, p in CUSTOMER_RULES_DUCK
            ) + ")"
        ),
        "on_time_rows": (
            f"SELECT o_orderkey, o_orderdate FROM {_B} WHERE CAST(o_orderdate AS DATE) = DATE '1998-10-03'"
        ),
        "multi_section_timeliness": _timeliness_sql(),
        "completeness_sink": multi,
        "accuracy_sink": report,
        "filter_gt": f"SELECT o_orderkey, o_totalprice FROM {_B} WHERE o_totalprice > 400000",
        "rule_violations": _violating_sql("prio LIKE '1%'", "o_orderkey, prio"),
        "rule_violations_expr": _violating_sql("status IN ('F')", "o_orderkey, status"),
        "rule_not_null": _violating_sql("status IS NOT NULL", "o_orderkey"),
        "rule_like": _violating_sql("prio LIKE '%HIGH'", "o_orderkey, prio"),
        "rule_in_list": _violating_sql(
            "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')", "o_orderkey, o_orderpriority"
        ),
        "rule_regex_find": _violating_sql("regexp_matches(prio, '([1-3])-')", "o_orderkey, prio"),
        "rule_regex_full": _violating_sql(
            "regexp_matches(CAST(o_orderkey AS VARCHAR), '^([0-9]{1,4})$')", "o_orderkey"
        ),
        "rule_between": _violating_sql("o_totalprice BETWEEN 1000 AND 400000", "o_orderkey, o_totalprice"),
        "rule_compound": _violating_sql("(prio IS NOT NULL AND regexp_matches(prio, '([1-3])-'))", "o_orderkey, prio"),
        "project_sort_desc": f"SELECT o_orderkey, o_totalprice FROM {_B} ORDER BY o_totalprice DESC, o_orderkey",
        "rule_flag": f"SELECT o_orderkey, CASE WHEN prio LIKE '1%' THEN 1 ELSE 0 END AS valid FROM {_B}",
        "null_label": f"SELECT o_orderkey, coalesce(prio, 'NULL') AS prio FROM {_B}",
        "row_count": f"SELECT count(*) AS count_data FROM {_B}",
        "violation_count": f"SELECT count(*) FILTER (WHERE NOT (prio LIKE '1%')) AS count_invalid FROM {_B}",
        "pass_percentage": (
            "SELECT CASE WHEN count(*) > 0 THEN (count(*) - count(*) FILTER (WHERE NOT (prio LIKE '1%'))) "
            f"/ count(*) * 100 ELSE 0.0 END AS percentage_valid FROM {_B}"
        ),
        "group_count_desc": (
            "SELECT coalesce(prio, 'NULL') AS value, count(*) AS \"count\" "
            f"FROM {_B} GROUP BY 1 ORDER BY \"count\" DESC, value"
        ),
        "distinct_values": f"SELECT DISTINCT prio FROM {_B} WHERE NOT (prio IS NOT NULL AND prio LIKE '1%')",
        "group_max": f"SELECT k1, k2, max(price) AS max_source_price FROM {_S} GROUP BY k1, k2",
        "group_sum": f"SELECT k1, k2, sum(qty) AS sum_source_qty FROM {_S} GROUP BY k1, k2",
        "group_multi_agg": (
            "SELECT k1, k2, max(price) AS max_source_price, max(qty) AS max_source_qty, "
            f"sum(qty) AS sum_source_qty FROM {_S} GROUP BY k1, k2"
        ),
        "inner_join_keys": (
            "SELECT a.k1, a.k2, p AS max_source_price, q AS max_target_price "
            f"FROM (SELECT k1, k2, max(price) AS p FROM {_S} GROUP BY k1, k2) a JOIN "
            f"(SELECT k1, k2, max(price) AS q FROM {_T} GROUP BY k1, k2) b ON a.k1 = b.k1 AND a.k2 = b.k2"
        ),
        "outer_join_keys": (
            "SELECT coalesce(s.k1, t.k1) AS k1, coalesce(s.k2, t.k2) AS k2, j.max_source_price, "
            f"t.max_target_price, j.price_accuracy FROM (SELECT k1, k2 FROM {_S}) s FULL OUTER JOIN "
            f"(SELECT k1, k2, max(price) AS max_target_price FROM {_T} GROUP BY k1, k2) t "
            f"ON s.k1 = t.k1 AND s.k2 = t.k2 LEFT JOIN ({_price_check_sql()}) j ON t.k1 = j.k1 AND t.k2 = j.k2"
        ),
        "rule_subquery": _subquery_card_sql(),
        "rule_subquery_profile": _profile_sql(_C, _subquery_rules(False)),
        "rule_subquery_rate": _rules_sql(_C, _subquery_rules(False), "", _RATE),
        "invalid_profile_parts": _parts_sql(),
        "folder_counts": _folder_sql(_COUNTS),
        "folder_profile_sink": "\nUNION ALL\n".join(
            _profile_sql(src, rules, _place("tpch", t)) for t, src, rules in _folder_rules()
        ),
        "folder_timeliness": _timeliness_sql() + (
            " UNION ALL SELECT 'tpch', 'events', 'ts', '1998-10-03', count(*), "
            f"count(*) FILTER (WHERE CAST(ts AS DATE) = {_DAY}), "
            f"count(*) FILTER (WHERE CAST(ts AS DATE) = {_DAY}) / nullif(count(*), 0) * 100 FROM events"
        ),
        "folder_rate": _folder_sql(_RATE),
        "folder_accuracy_sink": report + " UNION ALL " + _report_sql(*other),
        "folder_reconciliation": (
            _reconcile_sql(_S, _T, "", presence=False) + " UNION ALL " + _reconcile_sql(*other, "", presence=False)
        ),
        "folder_availability": days,
        "checked_day_counts": _rules_sql(
            f"(SELECT * FROM {_B} WHERE CAST(o_orderdate AS DATE) = {_DAY})", [(n, n, p) for n, p in rules[:2]],
            _place("tpch", "orders_b"), _COUNTS,
        ),
        "checked_day_reconciliation": _reconcile_sql(f"(SELECT * FROM {day[0]} WHERE qty > 10)", day[1], "FULL"),
        "reconcile_outer": _reconcile_sql(_S, _T, "FULL"),
        "availability": days,
        "availability_hours": hours,
    }
