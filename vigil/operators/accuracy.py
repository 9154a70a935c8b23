"""Accuracy: do per-key aggregates of a source and a target table agree?

A rule names a source column, a target column, an aggregate (``max`` or
``sum``) and a threshold; the check is the *signed* difference
``source_agg - target_agg <= threshold`` (a target above its source always
passes; NULL on either side gives NULL).

Output names follow the catalog convention: ``{agg}_source_{source_col}``,
``{agg}_target_{target_col}`` and ``{target_col}_accuracy``.

Plans (all rules at once, never one pass per rule):

* :func:`rule_check` / :func:`reconcile` - one row per key present on both
  sides: one grouped aggregate per side, one inner equi-join.
* :func:`reconcile_outer` - one row per key of either side, marked with the side(s) that
  have it: the same two aggregates, one full outer join.
* :func:`target_check` - one row per key of the target: both aggregates from one scan of
  rows that tell the sides apart, one shuffle, no join.
* :func:`accuracy_report` - one row per *source row* (the report keeps the
  source's duplicate keys, NULL keys and source-only keys, the latter two with
  NULL aggregates and checks).  Instead of joining every source row back to
  the per-key results, the source aggregate also counts its rows and each
  per-key result is repeated that many times.  Both sides are therefore read
  once, the shuffles are the two map-side-combined aggregates (the join
  between them is co-partitioned) and one of per-key rows.  That last one
  bounds the output of every task: each key is cut into chunks of at most
  ``chunk_rows`` rows, and the chunks are hashed over an explicit
  ``spark.sql.shuffle.partitions`` tasks before they are expanded.  A key
  holding a third of the table is spread like any other, and AQE, which sizes
  partitions by their (small) input, cannot merge the expansion into a few
  tasks that would each write a large share of the report.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.rules import column_named


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: Aggregates a rule may name.
AGGREGATES = {"max": F.max, "sum": F.sum}

#: Largest number of report rows generated from one per-key row in one step.
CHUNK_ROWS = 100_000


def _number(value) -> str:
    """A threshold as an SQL literal; numeric text (YAML reads 2e-2 as text) counts as its number."""
    if isinstance(value, str):
        try:
            value = Decimal(value.strip())
        except InvalidOperation:
            raise ValueError(f"a threshold must be a number, not {value!r}") from None
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal)) or not math.isfinite(value):
        raise ValueError(f"a threshold must be a finite number, not {value!r}")
    if isinstance(value, float):
        return f"CAST({value!r} AS DOUBLE)"
    return format(value, "f") if isinstance(value, Decimal) else str(value)


def _aligned(df: DataFrame, names) -> DataFrame:
    """``df`` with each of ``names`` spelled as given."""
    found = {column_named(df, n): n for n in names}
    return df.select(*[F.col(_q(c)).alias(found.get(c, c)) for c in df.columns])


@dataclass(frozen=True)
class AccuracyRule:
    name: str
    source_col: str
    target_col: str
    aggfunc: str = "max"
    threshold: float = 0
    absolute: bool = False  # off: the signed difference, as catalogs define it

    def __post_init__(self):
        if self.aggfunc not in AGGREGATES:
            raise ValueError(
                f"accuracy rule {self.name!r}: unknown aggfunc {self.aggfunc!r}; expected one of {sorted(AGGREGATES)}"
            )
        _number(self.threshold)

    @property
    def source_alias(self) -> str:
        return f"{self.aggfunc}_source_{self.source_col}"

    @property
    def target_alias(self) -> str:
        return f"{self.aggfunc}_target_{self.target_col}"

    @property
    def check_alias(self) -> str:
        return f"{self.target_col}_accuracy"

    def source_agg(self) -> Column:
        return AGGREGATES[self.aggfunc](F.col(_q(self.source_col))).alias(self.source_alias)

    def target_agg(self) -> Column:
        return AGGREGATES[self.aggfunc](F.col(_q(self.target_col))).alias(self.target_alias)

    def check(self, src: Column, tgt: Column) -> Column:
        diff = src - tgt
        if self.absolute:
            diff = F.abs(diff)
        return diff <= F.expr(_number(self.threshold))

    def check_sql(self, src: str, tgt: str) -> str:
        """:meth:`check` as SQL text over two SQL expressions."""
        diff = f"({src}) - ({tgt})"
        if self.absolute:
            diff = f"abs({diff})"
        return f"{diff} <= {_number(self.threshold)}"


def as_accuracy_rules(rules) -> list[AccuracyRule]:
    """Accept AccuracyRules or a catalog mapping ``{name: {source_cols, target_cols, aggfunc, threshold}}``."""
    if isinstance(rules, AccuracyRule):
        return [rules]
    if isinstance(rules, dict):
        out = []
        for name, spec in rules.items():
            out.append(
                AccuracyRule(
                    name=str(name),
                    source_col=str(spec["source_cols"]).strip(),
                    target_col=str(spec["target_cols"]).strip(),
                    aggfunc=str(spec.get("aggfunc", "max")).strip(),
                    threshold=spec.get("threshold", 0) if spec.get("threshold") is not None else 0,
                    absolute=bool(spec.get("absolute", False)),
                )
            )
        rules = out
    rules = list(rules)
    if not rules:
        raise ValueError("at least one accuracy rule is required")
    return rules


def parse_keys(keys) -> list[str]:
    """``"lac,ci"`` or ``["lac", "ci"]`` -> ``["lac", "ci"]`` (trimmed)."""
    if isinstance(keys, str):
        keys = keys.split(",")
    out = [k.strip() for k in keys if k and k.strip()]
    if not out:
        raise ValueError("accuracy needs at least one group-by key")
    return out


def _validate(source: DataFrame, target: DataFrame, keys: list[str], rules: list[AccuracyRule], checks: list[str],
              target_keys: list[str] | None = None):
    for side, df, by, cols in (
        ("source", source, keys, [r.source_col for r in rules]),
        ("target", target, target_keys or keys, [r.target_col for r in rules]),
    ):
        fields = {f.name: f.dataType for f in _aligned(df, [*by, *cols]).schema.fields}
        for k in by:
            if k not in fields:
                raise ValueError(f"{side} has no key column {k!r}")
        for c in cols:
            if c not in fields:
                raise ValueError(f"{side} has no column {c!r}")
            if not isinstance(fields[c], T.NumericType):
                raise TypeError(
                    f"accuracy compares numbers; {side} column {c!r} is {fields[c].simpleString()}"
                )
    names = list(keys) + [r.source_alias for r in rules] + [r.target_alias for r in rules] + checks
    dup = sorted({n for n in names if names.count(n) > 1})
    if dup:
        raise ValueError(f"accuracy rules produce duplicate output columns {dup}")


def side_aggregates(df: DataFrame, keys, rules, side: str) -> DataFrame:
    """``groupBy(keys)`` with every rule's aggregate of one side in one pass."""
    keys = parse_keys(keys)
    rules = as_accuracy_rules(rules)
    aggs = [r.source_agg() if side == "source" else r.target_agg() for r in rules]
    cols = [r.source_col if side == "source" else r.target_col for r in rules]
    return _aligned(df, [*keys, *cols]).groupBy(*map(_q, keys)).agg(*aggs)


def _both_sides(source, target, keys, rules):
    s = side_aggregates(source, keys, rules, "source").alias("s")
    t = side_aggregates(target, keys, rules, "target").alias("t")
    cond = [F.col(f"s.{_q(k)}") == F.col(f"t.{_q(k)}") for k in keys]
    return s.join(t, cond, "inner")


def rule_check(source: DataFrame, target: DataFrame, keys, rule: AccuracyRule) -> DataFrame:
    """One rule: keys, source aggregate, target aggregate, check - keys on both sides only."""
    return accuracy_by_key(source, target, keys, [rule])


def accuracy_by_key(source: DataFrame, target: DataFrame, keys, rules) -> DataFrame:
    """All rules, one row per key present on both sides: keys, then per rule
    (source agg, target agg, ``{target_col}_accuracy``)."""
    keys = parse_keys(keys)
    rules = as_accuracy_rules(rules)
    _validate(source, target, keys, rules, [r.check_alias for r in rules])
    j = _both_sides(source, target, keys, rules)
    cols = [f"s.{_q(k)} AS {_q(k)}" for k in keys]
    for r in rules:
        src, tgt = f"s.{_q(r.source_alias)}", f"t.{_q(r.target_alias)}"
        cols += [f"{src} AS {_q(r.source_alias)}", f"{tgt} AS {_q(r.target_alias)}",
                 f"{r.check_sql(src, tgt)} AS {_q(r.check_alias)}"]
    return j.selectExpr(*cols)


def reconcile(source: DataFrame, target: DataFrame, keys, rules, check_suffix: str = "_check") -> DataFrame:
    """Per-key reconciliation over several columns: keys, all source aggregates,
    all target aggregates, then one ``{rule name}_check`` per rule."""
    keys = parse_keys(keys)
    rules = as_accuracy_rules(rules)
    checks = [f"{r.name}{check_suffix}" for r in rules]
    _validate(source, target, keys, rules, checks)
    j = _both_sides(source, target, keys, rules)
    cols = [f"s.{_q(k)} AS {_q(k)}" for k in keys]
    cols += [f"s.{_q(r.source_alias)} AS {_q(r.source_alias)}" for r in rules]
    cols += [f"t.{_q(r.target_alias)} AS {_q(r.target_alias)}" for r in rules]
    cols += [
        f"{r.check_sql(f's.{_q(r.source_alias)}', f't.{_q(r.target_alias)}')} AS {_q(c)}"
        for r, c in zip(rules, checks)
    ]
    return j.selectExpr(*cols)


#: Join types of a reconciliation -> the kinds of keys that it keeps.
JOINS = {
    "inner": ("both",), "left": ("both", "source"), "right": ("both", "target"),
    "full_outer": ("both", "source", "target"),
}
_JOIN_NAMES = {"outer": "full_outer", "full": "full_outer", "left_outer": "left", "right_outer": "right"}


def join_type(how: str) -> str:
    """A catalog's join type as one of :data:`JOINS`."""
    name = str(how).strip().lower().replace(" ", "_")
    name = _JOIN_NAMES.get(name, name)
    if name not in JOINS:
        raise ValueError(f"unknown join type {how!r}; expected one of {sorted(JOINS)}")
    return name


def reconcile_outer(
    source: DataFrame,
    target: DataFrame,
    keys,
    rules,
    target_keys=None,
    how: str = "full_outer",
    check_suffix: str = "_check",
) -> DataFrame:
    """Per-key reconciliation that shows what either side lacks.

    ``keys`` are the source's key columns, ``target_keys`` (default: the same names) the
    target's, matched by position; the result has the source's names.  Columns: keys,
    ``presence`` (``both``, ``source``: the target lacks the key, ``target``: the source
    does), all source aggregates, all target aggregates, one ``{rule name}_check`` per
    rule (NULL unless both sides have the key).  ``how`` keeps only some of the kinds
    (:data:`JOINS`).  A key with a NULL part equals no key: it is a row of its own on
    each side that has it.
    """
    how = join_type(how)
    keys = parse_keys(keys)
    theirs = parse_keys(target_keys) if target_keys is not None else keys
    rules = as_accuracy_rules(rules)
    if len(theirs) != len(keys):
        raise ValueError(f"{len(keys)} source keys and {len(theirs)} target keys: {keys} and {theirs}")
    checks = [f"{r.name}{check_suffix}" for r in rules]
    _validate(source, target, keys, rules, [*checks, "presence"], theirs)
    mark = F.lit(True)
    s = side_aggregates(source, keys, rules, "source").withColumn("_here", mark).alias("s")
    t = side_aggregates(target, theirs, rules, "target").withColumn("_here", mark)
    t = t.withColumnsRenamed({a: f"_key{i}" for i, a in enumerate(theirs)})
    t = t.withColumnsRenamed({f"_key{i}": k for i, k in enumerate(keys)}).alias("t")
    joined = s.join(t, [F.col(f"s.{_q(k)}") == F.col(f"t.{_q(k)}") for k in keys], how)
    cols = [f"coalesce(s.{_q(k)}, t.{_q(k)}) AS {_q(k)}" for k in keys]
    cols.append("CASE WHEN s._here AND t._here THEN 'both' WHEN s._here THEN 'source' ELSE 'target' END AS presence")
    cols += [f"s.{_q(r.source_alias)} AS {_q(r.source_alias)}" for r in rules]
    cols += [f"t.{_q(r.target_alias)} AS {_q(r.target_alias)}" for r in rules]
    cols += [
        f"CASE WHEN s._here AND t._here THEN {r.check_sql(f's.{_q(r.source_alias)}', f't.{_q(r.target_alias)}')} END AS {_q(c)}"
        for r, c in zip(rules, checks)
    ]
    return joined.selectExpr(*cols)


def target_check(rows: DataFrame, keys, rules, of_source: str) -> DataFrame:
    """:func:`accuracy_by_key` of the rows of both sides in one table, and the target's other keys.

    ``of_source`` is a boolean column, true on the source's rows.  One row per key of the target;
    the source aggregates and the checks of a key that the source lacks, or with a NULL part (it
    equals no key), are NULL.  Both sides come from one scan and one map-side-combined aggregate.
    """
    keys = parse_keys(keys)
    rules = as_accuracy_rules(rules)
    source, target = F.col(_q(of_source)), ~F.col(_q(of_source))
    _validate(rows, rows, keys, rules, [r.check_alias for r in rules])
    rows = _aligned(rows, [*keys, of_source, *(c for r in rules for c in (r.source_col, r.target_col))])
    aggs = [AGGREGATES[r.aggfunc](F.when(source, F.col(_q(r.source_col)))).alias(r.source_alias) for r in rules]
    aggs += [AGGREGATES[r.aggfunc](F.when(target, F.col(_q(r.target_col)))).alias(r.target_alias) for r in rules]
    both = rows.groupBy(*map(_q, keys)).agg(*aggs, F.bool_or(target).alias("_here")).where("_here")
    whole = " AND ".join(f"{_q(k)} IS NOT NULL" for k in keys)
    cols = [_q(k) for k in keys]
    for r in rules:
        src, tgt = f"CASE WHEN {whole} THEN {_q(r.source_alias)} END", _q(r.target_alias)
        cols += [f"{src} AS {_q(r.source_alias)}", tgt, f"{r.check_sql(src, tgt)} AS {_q(r.check_alias)}"]
    return both.selectExpr(*cols)


def accuracy_report(
    source: DataFrame,
    target: DataFrame,
    keys,
    rules,
    chunk_rows: int = CHUNK_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """One row per source row: keys, then per rule (source agg, target agg, check).

    Aggregates and checks are filled only where the key has no NULL part and
    occurs on both sides; otherwise they are NULL.  Target-only keys do not
    appear.
    """
    keys = parse_keys(keys)
    rules = as_accuracy_rules(rules)
    _validate(source, target, keys, rules, [r.check_alias for r in rules])

    source = _aligned(source, [*keys, *(r.source_col for r in rules)])
    target = _aligned(target, [*keys, *(r.target_col for r in rules)])
    s = source.groupBy(*map(_q, keys)).agg(F.count(F.lit(1)).alias("_rows"), *[r.source_agg() for r in rules]).alias("s")
    t = (
        target.groupBy(*map(_q, keys))
        .agg(*[r.target_agg() for r in rules])
        .withColumn("_hit", F.lit(True))
        .alias("t")
    )
    cond = [F.col(f"s.{_q(k)}") == F.col(f"t.{_q(k)}") for k in keys]
    joined = s.join(t, cond, "left")

    out = [f"s.{_q(k)} AS {_q(k)}" for k in keys]
    for r in rules:
        src = f"CASE WHEN t._hit THEN s.{_q(r.source_alias)} END"
        tgt = f"t.{_q(r.target_alias)}"
        out += [f"{src} AS {_q(r.source_alias)}", f"{tgt} AS {_q(r.target_alias)}",
                f"{r.check_sql(src, tgt)} AS {_q(r.check_alias)}"]
    per_key = joined.selectExpr(*out, "s._rows AS _rows")
    return _expand(per_key, keys, "_rows", chunk_rows, partitions)


def expansion_partitions(spark) -> int:
    """Tasks that generate repeated rows: the larger of ``spark.sql.shuffle.partitions``
    and AQE's initial partition number, when one is set."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    if initial not in (None, "", "None"):
        parts = max(parts, int(initial))
    return parts


def _expand(per_key: DataFrame, keys: list[str], rows_col: str, chunk_rows: int,
            partitions: int | None = None) -> DataFrame:
    """Repeat each row ``rows_col`` times (and drop that column).

    Each row is cut into chunks of at most ``chunk_rows`` repeats; the chunks
    are hashed over an explicit number of tasks (``partitions``, default
    :func:`expansion_partitions`; AQE does not coalesce an explicit count) and
    only then expanded, so every task writes about total / partitions rows
    whatever the key distribution.  The flip side of a count AQE may not
    merge: a small report in a session sized for huge shuffles still runs
    that many (mostly empty) tasks; pass ``partitions`` to size it.
    """
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be positive")
    names = [_q(c) for c in per_key.columns if c != rows_col]
    rows, c = _q(rows_col), int(chunk_rows)
    parts = partitions or expansion_partitions(per_key.sparkSession)
    return (
        per_key.selectExpr(*names, rows, f"explode(sequence(0, ceil({rows} / {c}) - 1)) AS _chunk")
        .repartition(parts, *map(_q, keys), "_chunk")
        .selectExpr(*names, f"explode(array_repeat(0, CAST(least({c}, {rows} - _chunk * {c}) AS INT))) AS _r")
        .drop("_r")
    )


def join_key_rows(key_rows: DataFrame, keyed: DataFrame, keys, how: str = "full_outer",
                  chunk_rows: int = CHUNK_ROWS, partitions: int | None = None) -> DataFrame:
    """``key_rows.join(keyed, keys, how)`` for a ``key_rows`` made of key columns only.

    Duplicate key rows are identical, so they are counted (a map-side-combined
    aggregate), joined at key level, and repeated by their count afterwards:
    the rows themselves are never shuffled, and a key holding a third of them
    is not one join task's third (AQE cannot split skewed full outer joins).
    Same rows as the plain join for inner, left, right and full outer joins,
    including NULL keys and duplicate keys on either side.
    """
    keys = parse_keys(keys)
    extra = [c for c in key_rows.columns if c not in keys]
    if extra:
        raise ValueError(f"key_rows may hold only the key columns; found {extra}")
    how = {"outer": "full_outer", "full": "full_outer", "fullouter": "full_outer",
           "left_outer": "left", "leftouter": "left", "right_outer": "right", "rightouter": "right"}.get(how, how)
    if how not in ("inner", "left", "right", "full_outer"):
        raise ValueError(f"unsupported join type {how!r}")
    c = key_rows.groupBy(*map(_q, keys)).agg(F.count(F.lit(1)).alias("_rows")).alias("c")
    u = keyed.alias("u")
    j = c.join(u, [F.col(f"c.{_q(k)}") == F.col(f"u.{_q(k)}") for k in keys], how)
    if how in ("inner", "left"):
        out = [f"c.{_q(k)} AS {_q(k)}" for k in keys]
    elif how == "right":
        out = [f"u.{_q(k)} AS {_q(k)}" for k in keys]
    else:
        out = [f"coalesce(c.{_q(k)}, u.{_q(k)}) AS {_q(k)}" for k in keys]
    out += [f"u.{_q(col)} AS {_q(col)}" for col in keyed.columns if col not in keys]
    # a keyed row with no matching key rows appears once (right / full outer)
    per_key = j.selectExpr(*out, "coalesce(c._rows, 1) AS _rows")
    return _expand(per_key, keys, "_rows", chunk_rows, partitions)
