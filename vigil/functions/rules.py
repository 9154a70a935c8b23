"""Rules as Spark Columns.

A completeness rule is a SQL predicate written by the user (``"x IS NOT NULL"``,
``"x LIKE 'R%'"``, ``"x RLIKE '...'"``...).  It is handed to Catalyst as text
(``F.expr``), so every predicate Spark SQL understands is a valid rule, it is
optimised like any other filter (LIKE-prefix becomes StartsWith, negated
IS NOT NULL / IN / BETWEEN can reach the scan), and nothing runs in Python.

A predicate may hold subqueries (``x IN (SELECT ...)``, ``EXISTS (...)``) on tables or
views that the session knows; see :func:`listed_in` for long lists.

Two readings of "the row satisfies the rule" exist and both are kept:

* violation reading (scorecard, violation filters): a row is *bad* only when
  the predicate is FALSE.  ``NOT NULL`` is NULL, not TRUE, so a NULL
  predicate result counts as valid.
* flag reading (completeness rate): a row is *good* only when the predicate
  is TRUE, so a NULL predicate result counts as invalid.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text shown for a NULL value in invalid-value profiles.
NULL_LABEL = "NULL"


@dataclass(frozen=True)
class Rule:
    """One completeness rule.

    ``name`` is the rule key of the catalog; by default it is also the column
    whose failing values are profiled.  ``column`` overrides that, so one
    column can carry several rules.
    """

    name: str
    predicate: str
    column: str | None = None

    @property
    def target(self) -> str:
        return self.column or self.name


def listed_in(column: str, query: str) -> str:
    """The predicate ``column IN (query)``, written so that it joins by key at any size.

    Spark turns a negated ``IN (SELECT ...)`` over nullable columns into a nested-loop join
    against a broadcast of the whole list.  Here the list is looked up by an equi-join
    (``EXISTS``), and NULLs, an empty list included, are answered as ``IN`` does: a list
    without the value but with a NULL, or a NULL value, gives NULL.
    """
    rows = f"({query}\n) AS _listed(_value)"
    return (
        f"CASE WHEN EXISTS (SELECT 1 FROM {rows} WHERE _value = {sql_ident(column)}) THEN true "
        f"WHEN (SELECT count(1) FROM {rows}) = 0 THEN false "
        f"WHEN {sql_ident(column)} IS NULL OR (SELECT count_if(_value IS NULL) FROM {rows}) > 0 THEN NULL "
        "ELSE false END"
    )


def as_rules(rules) -> list[Rule]:
    """Accept a mapping ``{name: predicate}``, ``(name, predicate)`` pairs or Rules."""
    if isinstance(rules, dict):
        items = list(rules.items())
    else:
        items = list(rules)
    out = []
    for item in items:
        if isinstance(item, Rule):
            out.append(item)
        else:
            name, pred = item
            out.append(Rule(str(name), str(pred)))
    if not out:
        raise ValueError("at least one rule is required")
    return out


def sql_ident(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(text: str) -> str:
    """A string literal for SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column_named(df: DataFrame, name: str) -> str:
    """The name of the column that Spark would take for ``name``: case counts only where
    the session says so."""
    if name in df.columns or df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true":
        return name
    hits = [c for c in df.columns if c.lower() == name.lower()]
    return hits[0] if len(hits) == 1 else name


def used_columns(df: DataFrame, expressions: list[str]) -> list[str]:
    """The columns of ``df`` that SQL expressions read, those inside subqueries included, in
    the order of ``df``; read off the analyzed plan, so names may be in any case."""
    if not hasattr(df, "_jdf"):  # Spark Connect shows no plan
        return df.columns
    ids = lambda attributes: [attributes.apply(i).exprId().id() for i in range(attributes.size())]
    read = set(ids(df.selectExpr(*expressions)._jdf.queryExecution().analyzed().references().toSeq()))
    return [c for c, i in zip(df.columns, ids(df._jdf.queryExecution().analyzed().output())) if i in read]


def predicate(rule: Rule | str) -> Column:
    """The rule as a boolean Column (three-valued)."""
    text = rule.predicate if isinstance(rule, Rule) else rule
    return F.expr(text)


def closed(rule: Rule | str) -> str:
    """The predicate's text for use inside longer SQL: a line end closes a trailing comment."""
    return (rule.predicate if isinstance(rule, Rule) else rule) + "\n"


def violated(rule: Rule | str) -> Column:
    """TRUE exactly when the predicate is FALSE; NULL predicate -> NULL (not a violation)."""
    return ~predicate(rule)


def violated_text(rule: Rule | str) -> str:
    """Text form of :func:`violated`, for ``DataFrame.filter(str)``."""
    text = rule.predicate if isinstance(rule, Rule) else rule
    return f"NOT ({closed(text)})"


def flag(rule: Rule | str) -> Column:
    """1 when the predicate is TRUE, else 0 (NULL predicate -> 0)."""
    return F.when(predicate(rule), F.lit(1)).otherwise(F.lit(0))


def null_label(column: Column | str, label: str = NULL_LABEL) -> Column:
    """The value as text, NULL shown as ``label``.

    The cast comes first so the label never has to be cast to the column's
    type (which fails for numeric and date columns under ANSI mode).
    """
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(label))
