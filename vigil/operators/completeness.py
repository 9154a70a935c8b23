"""Completeness: rule violations, scorecards and invalid-value profiles.

Every function takes a DataFrame (and rules) and returns a DataFrame; none
runs an action.  The scorecard is built from ONE scan of the table:

    scan -> per row, one truth column per rule (a plain projection, so rules may
            hold subqueries: Spark joins them below it)
         -> one (rule, value) item per violated rule plus one row-count marker
         -> partial+final hash aggregate on (rule, value)

That aggregate (the long profile) holds everything: the marker's count is the
row count, a rule's item counts sum to its violations, and the items
themselves are the invalid-value profile.  Partial aggregation on the map side
means a value shared by a third of all rows reaches the shuffle once per
task, never once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.rules import (
    NULL_LABEL,
    Rule,
    as_rules,
    closed,
    column_named,
    flag,
    null_label,
    sql_ident,
    sql_string,
    violated,
    violated_text,
)
from vigil.functions.text import ordered_concat, ordered_parts
from vigil.sources.sinks import stage

_TOTAL = -1  # rule index of the row-count marker in the long profile


# ---------------------------------------------------------------------------
# single-rule building blocks


def violations(df: DataFrame, rule: Rule | str, text_form: bool = False) -> DataFrame:
    """Rows that break the rule (predicate FALSE).  NULL predicate rows are kept out.

    ``text_form`` filters with the SQL text ``NOT (rule)`` instead of the negated
    Column; both give the same plan.
    """
    if text_form:
        return df.filter(violated_text(rule))
    return df.filter(violated(rule))


def rule_flags(df: DataFrame, rules, keep: list[str] | None = None, name: str = "valid") -> DataFrame:
    """Per row a 1/0 flag per rule (``valid`` for a single rule, else ``valid_<rule>``)."""
    rs = as_rules(rules)
    cols = [F.col(c) for c in (keep or [])]
    if len(rs) == 1:
        cols.append(flag(rs[0]).alias(name))
    else:
        cols += [flag(r).alias(f"{name}_{r.name}") for r in rs]
    return df.select(*cols)


def label_nulls(df: DataFrame, columns: list[str], label: str = NULL_LABEL) -> DataFrame:
    """Replace the named columns by their text, NULL shown as ``label``."""
    return df.withColumns({c: null_label(c, label) for c in columns})


def row_count(df: DataFrame, alias: str = "count_data") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def violation_count(df: DataFrame, rule: Rule | str, alias: str = "count_invalid") -> DataFrame:
    return df.agg(F.count_if(violated(rule)).alias(alias))


def _percentage(n: Column, bad: Column) -> Column:
    # ((n - bad) / n) * 100, and 0 for an empty table - the scorecard's convention.
    return F.when(n > 0, (n - bad) / n * 100).otherwise(F.lit(0.0))


def pass_percentage(df: DataFrame, rule: Rule | str, alias: str = "percentage_valid") -> DataFrame:
    agg = df.agg(F.count(F.lit(1)).alias("_n"), F.count_if(violated(rule)).alias("_bad"))
    return agg.select(_percentage(F.col("_n"), F.col("_bad")).alias(alias))


def group_count_desc(df: DataFrame, column: str, label: str = NULL_LABEL) -> DataFrame:
    """(value, count) of a column, NULL labelled, most frequent first, ties by value."""
    return (
        df.groupBy(null_label(column, label).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc("value"))
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


# ---------------------------------------------------------------------------
# all rules at once


def completeness_rate(df: DataFrame, rules) -> DataFrame:
    """(column, rate): share of rows whose predicate is TRUE (NULL counts as failing).

    One aggregate for all rules; NULL rate for an empty table.
    """
    rs = as_rules(rules)
    agg = df.selectExpr("count(1) AS _n", *[f"count_if({closed(r)}) AS _ok{i}" for i, r in enumerate(rs)])
    rows = ", ".join(
        f"named_struct('column', {sql_string(r.name)}, 'rate', CAST(try_divide(_ok{i}, _n) AS DOUBLE))"
        for i, r in enumerate(rs)
    )
    return agg.selectExpr(f"inline(array({rows}))")


#: Column types grouped by their own value; anything else is grouped by its text.
_TYPED_SLOTS = (
    T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def _slots(df: DataFrame, rules: list[Rule], label: str) -> tuple[list[str], dict[str, tuple[int, str]]]:
    """Value slots: one per column type among the rules' columns.

    Returns the slot types (SQL names) and, per rule column, (slot, value
    expression).  Columns of other types (or not found by name) go to the text
    slot as ``CAST(col AS STRING)``.  Text values get the NULL label before
    grouping (it costs nothing there), so a NULL and a literal label text are
    one value, as when the label is applied first; other types are labelled
    after the aggregate.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    types: list[str] = []
    where: dict[str, tuple[int, str]] = {}
    for r in rules:
        col = r.target
        if col in where:
            continue
        dtype = fields.get(column_named(df, col))
        if isinstance(dtype, T.StringType):
            tname, expr = "string", f"coalesce({sql_ident(col)}, {sql_string(label)})"
        elif dtype is not None and isinstance(dtype, _TYPED_SLOTS):
            tname, expr = dtype.simpleString(), sql_ident(col)
        else:
            tname, expr = "string", f"coalesce(CAST({sql_ident(col)} AS STRING), {sql_string(label)})"
        if tname not in types:
            types.append(tname)
        where[col] = (types.index(tname), expr)
    return types, where


def _failure_items(df: DataFrame, rules: list[Rule], first: int, with_total: bool,
                   types: list[str], where: dict) -> DataFrame:
    """(rule, v0..vn): one item per violated rule per row, plus (optionally) a
    marker row per input row.  ``first`` is the index of ``rules[0]``.

    The failing value stays in its own type (slot ``v<k>`` for the k-th column
    type) so rows are grouped on typed values and turned into text only after
    the aggregate, once per distinct value instead of once per failing row.
    The values and the rules' truths are columns of a projection below the generator:
    subqueries are allowed there, and an expression is compiled once however many items
    use it.  Items of rules that hold are NULL structs and are dropped by a plain filter
    after the generator - filtering inside the array would need a lambda, which runs
    outside generated code.
    """
    nulls = [f"CAST(NULL AS {t})" for t in types]
    values = {col: (slot, f"_value{j}") for j, (col, (slot, _)) in enumerate(where.items())}
    base = df.selectExpr(
        *[f"{expr} AS {values[col][1]}" for col, (_, expr) in where.items()],
        *[f"NOT ({closed(r)}) AS _broken{i}" for i, r in enumerate(rules, start=first)],
    )

    def item(rule_idx: int, slot: int | None, value: str | None) -> str:
        vals = [value if k == slot else nulls[k] for k in range(len(types))]
        fields = "".join(f", 'v{k}', {v}" for k, v in enumerate(vals))
        return f"named_struct('rule', {rule_idx}{fields})"

    items = [item(_TOTAL, None, None)] if with_total else []
    items += [f"CASE WHEN _broken{i} THEN {item(i, *values[r.target])} END" for i, r in enumerate(rules, start=first)]
    return base.selectExpr(f"inline(array({', '.join(items)}))").where("rule IS NOT NULL")


def _long_profile(df: DataFrame, rules: list[Rule], label: str, with_total: bool) -> DataFrame:
    """(rule, value, count).  Floating-point -0.0 and 0.0 (and NaNs) are one value,
    as in any Spark grouping.

    All rules share one generator and one aggregate, so one scan, however many
    there are; the scan reads the rules' columns only.
    """
    types, where = _slots(df, rules, label)
    slots = [f"v{k}" for k in range(len(types))]
    text = ", ".join([f"CAST({v} AS STRING)" for v in slots] + [sql_string(label)])
    items = _failure_items(df, rules, 0, with_total, types, where)
    prof = items.groupBy("rule", *slots).agg(F.count(F.lit(1)).alias("count"))
    return prof.selectExpr("rule", f"coalesce({text}) AS value", "count")


def _rule_names(rules: list[Rule]) -> Column:
    return F.element_at(F.array(*[F.lit(r.name) for r in rules]), F.col("rule") + 1)


def profile_rows(profile: DataFrame, rules) -> DataFrame:
    """(column_name, value, count) of a long profile (:func:`kept_profile`)."""
    return profile.where(f"rule != {_TOTAL}").select(_rule_names(as_rules(rules)).alias("column_name"), "value", "count")


def invalid_value_profile(df: DataFrame, rules, label: str = NULL_LABEL) -> DataFrame:
    """(column_name, value, count) over the rows that break each rule."""
    rs = as_rules(rules)
    return profile_rows(_long_profile(df, rs, label, with_total=False), rs)


def kept_profile(df: DataFrame, rules, label: str = NULL_LABEL, name: str = "profile") -> DataFrame:
    """The long profile (rule, value, count) with its row-count marker, written once to the
    shared folder: counts, failing values and texts are then read from it, and the table
    itself is scanned once.

    Counts are sums of the written rows, so a lost executor or a repeated write cannot
    count a row twice (metrics observed while writing could: tasks that are run again
    report again).
    """
    return stage(_long_profile(df, as_rules(rules), label, with_total=True), df.sparkSession, name)


def profile_counts(profile: DataFrame, rules, database: str | None = None, table: str | None = None) -> DataFrame:
    """The scorecard's counts of a long profile: one row per rule."""
    return _counted(_summed(profile, as_rules(rules)), database, table)


def profile_parts(profile: DataFrame, rules, part_bytes: int = 16 << 20, name: str = "parts") -> DataFrame:
    """(column, part, text): the JSON texts of a long profile in parts of ``part_bytes`` (see
    :func:`vigil.functions.text.ordered_parts`); ``[]`` as part 0 for a rule that none breaks."""
    rs = as_rules(rules)
    spark = profile.sparkSession
    parts = ordered_parts(
        profile.where(f"rule != {_TOTAL}"), keep=lambda rows: stage(rows, spark, name), part_bytes=part_bytes, **_JSON
    )
    listed = _listed(spark, rs)
    return listed.join(parts, F.col("_no") == F.col("rule"), "left").selectExpr(
        "column", "coalesce(part, 0) AS part", "coalesce(text, '[]') AS text"
    )


def invalid_profile_parts(df: DataFrame, rules, label: str = NULL_LABEL, part_bytes: int = 16 << 20) -> DataFrame:
    """The texts of :func:`invalid_profile_json` as rows (column, part, text) of bounded size: a
    rule's texts concatenate, by ``part``, to its one text.  For columns with any number of
    failing values; writes its sorted values to the shared folder when called."""
    rs = as_rules(rules)
    return profile_parts(_long_profile(df, rs, label, with_total=False), rs, part_bytes)


#: How the JSON text of a rule is put together from its failing values.
_JSON = {
    "group": "rule", "order": ["-count", "value"], "text": "to_json(named_struct('value', value, 'count', count))",
    "sep": ",", "prefix": "[", "suffix": "]",
}


def _json_texts(prof: DataFrame) -> DataFrame:
    """(rule, data_invalid): ``[{"value":..,"count":..},...]`` count desc, value asc."""
    return ordered_concat(prof, alias="data_invalid", **_JSON)


def _distinct_texts(prof: DataFrame, alias: str) -> DataFrame:
    """(rule, <alias>): distinct failing values joined by ``|`` in value order."""
    return ordered_concat(prof, group="rule", order=["value"], text="value", sep="|", alias=alias)


def _listed(spark, rules: list[Rule]) -> DataFrame:
    """(_no, column) of every rule."""
    names = ", ".join(sql_string(r.name) for r in rules)
    return spark.range(1).selectExpr(f"posexplode(array({names})) AS (_no, column)")


def _texts_per_rule(df: DataFrame, rules, label: str, texts, column: str, empty: str) -> DataFrame:
    """(column, <text>) for every rule, from one scan; ``empty`` for a rule that none breaks."""
    rs = as_rules(rules)
    found = texts(_long_profile(df, rs, label, with_total=False))
    return _listed(df.sparkSession, rs).join(found, F.col("_no") == F.col("rule"), "left").selectExpr(
        "column", f"coalesce({column}, {sql_string(empty)}) AS {column}"
    )


def invalid_profile_json(df: DataFrame, rules, label: str = NULL_LABEL) -> DataFrame:
    """(column, data_invalid) - the profile of M2 rendered as one JSON text per rule."""
    return _texts_per_rule(df, rules, label, _json_texts, "data_invalid", "[]")


def invalid_distinct_values(df: DataFrame, rules, label: str = NULL_LABEL) -> DataFrame:
    """(column, distinct_invalid) - distinct failing values joined by ``|``; empty text if none."""
    return _texts_per_rule(
        df, rules, label, lambda p: _distinct_texts(p, "distinct_invalid"), "distinct_invalid", ""
    )


def _head(database, table) -> list[str]:
    """database, table, column, count_data, count_valid - as SQL select items."""
    lit = lambda v: "CAST(NULL AS STRING)" if v is None else f"CAST({sql_string(str(v))} AS STRING)"
    return [
        f"{lit(database)} AS `database`",
        f"{lit(table)} AS `table`",
        "`column`",
        "CAST(count_data AS BIGINT) AS count_data",
        "CAST(count_valid AS BIGINT) AS count_valid",
    ]


def _counts_only(df: DataFrame, rules: list[Rule], database, table) -> DataFrame:
    agg = df.selectExpr("count(1) AS _n", *[f"count_if(NOT ({closed(r)})) AS _b{i}" for i, r in enumerate(rules)])
    per_rule = ", ".join(
        f"named_struct('column', {sql_string(r.name)}, 'count_data', _n, 'count_valid', _n - _b{i})"
        for i, r in enumerate(rules)
    )
    return _counted(agg.selectExpr(f"inline(array({per_rule}))"), database, table)


def _summed(prof: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, column, count_data, count_valid) of a long profile.

    Violations per rule (at most one row a rule, and the marker's count is the row count) are
    folded into one row with a rule -> count map (bounded by the rule list), then one row
    per rule comes from the rule list itself.
    """
    per_rule = prof.groupBy("rule").agg(F.sum("count").alias("c"))
    summary = per_rule.selectExpr(
        f"coalesce(max(CASE WHEN rule = {_TOTAL} THEN c END), 0) AS _n",
        "map_from_entries(collect_list(struct(rule, c))) AS _bad",
    )
    names = ", ".join(sql_string(r.name) for r in rules)  # a literal array: folded to one constant
    return summary.selectExpr("_n", "_bad", f"posexplode(array({names})) AS (rule, column)").selectExpr(
        "rule", "column", "_n AS count_data", "_n - coalesce(_bad[rule], 0) AS count_valid"
    )


def _counted(counts: DataFrame, database, table, *more: str) -> DataFrame:
    """The scorecard's columns from rows with column, count_data and count_valid."""
    return counts.selectExpr(
        *_head(database, table),
        "CASE WHEN count_data > 0 THEN (count_data - (count_data - count_valid)) / count_data * 100 "
        "ELSE CAST(0 AS DOUBLE) END AS percentage_valid",
        *more,
    )


def scorecard(
    df: DataFrame,
    rules,
    database: str | None = None,
    table: str | None = None,
    label: str = NULL_LABEL,
    invalid: str | None = "json",
    profile: DataFrame | None = None,
) -> DataFrame:
    """The completeness scorecard, one row per rule.

    Columns: database, table, column, count_data (long), count_valid (long),
    percentage_valid (double), and ``data_invalid`` (JSON, ``invalid="json"``)
    or ``distinct_invalid`` (``|``-joined, ``invalid="distinct"``), or no text
    column (``invalid=None``: one ``count_if`` aggregate, no profile at all).

    A rule's text is one cell, so it is bounded by Spark's 2 GB string limit;
    for columns with billions of distinct failing values use :func:`kept_profile` with
    :func:`profile_counts`, :func:`profile_rows` and :func:`profile_parts`.  ``profile`` is such a kept
    profile of ``df``, read in place of the table.
    """
    rs = as_rules(rules)
    if invalid not in ("json", "distinct", None):
        raise ValueError("invalid must be 'json', 'distinct' or None")
    if invalid is None:
        return _counts_only(df, rs, database, table)
    prof = profile if profile is not None else _long_profile(df, rs, label, with_total=True)
    counts = _summed(prof, rs)

    if invalid == "json":
        texts, text_col, empty = _json_texts(prof), "data_invalid", "[]"
    else:
        texts, text_col, empty = _distinct_texts(prof, "distinct_invalid"), "distinct_invalid", ""

    # Both sides have at most one row per rule.  The null-safe condition keeps
    # the optimizer from inferring an IS NOT NULL filter for the texts side and
    # pushing it into the profile aggregate: the two branches then share one
    # profile exchange (ReusedExchange), i.e. one scan of the table.
    joined = counts.join(texts, counts["rule"].eqNullSafe(texts["rule"]), "left")
    return _counted(joined, database, table, f"coalesce({text_col}, {sql_string(empty)}) AS {text_col}")