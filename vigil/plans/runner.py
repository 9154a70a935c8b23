"""Batch run over catalog sections.

For every section, each measure is one DataFrame plan; the rows of all sections are
unioned into one DataFrame per result table, so a table gets one append per run, not
one per section or rule.

Completeness is measured in one scan per table: the failing values of all rules are
aggregated and written once (:func:`vigil.operators.completeness.kept_profile`), and
counts, values and texts are read from what was written.  :func:`run` does that, and
stages database tables; everything else happens in :func:`write`.

Side choice: completeness and timeliness are measured on the *target* by
default (``side="source"`` measures the source instead); a measure whose table
is absent from the section yields no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.dates import checked_day
from vigil.functions.rules import NULL_LABEL, closed, sql_ident, used_columns
from vigil.operators.accuracy import accuracy_report, join_type, reconcile, reconcile_outer
from vigil.operators.availability import availability
from vigil.operators.completeness import completeness_rate, kept_profile, profile_counts, profile_rows, scorecard
from vigil.operators.timeliness import timeliness
from vigil.plans.catalog import Filter, Section
from vigil.sources.sinks import COMPLETENESS_TABLE, accuracy_table, new_run_id, stage
from vigil.sources.tables import JdbcTables, resolve

#: Result table of the failing values as rows.
PROFILE_TABLE = "completeness_profile"
#: Result tables of the further measures.
RATE_TABLE, AVAILABILITY_TABLE = "completeness_rate", "availability"

MEASURES = ("completeness", "timeliness", "accuracy", "rate", "reconciliation", "availability")
#: Catalog keys with a meaning of our own, off unless named in ``extensions``.
EXTENSIONS = ("date_checked", "additional_filter", "target_filter", "join_type")


def reconciliation_table(source_table: str, target_table: str) -> str:
    return f"reconciliation_{source_table}_to_{target_table}"


def _by_table(reports: list) -> dict[str, DataFrame]:
    """Result table name -> the rows of all reports (name, section, DataFrame) that go to it."""
    tables, first = {}, {}
    shape = lambda df: [(f.name, f.dataType) for f in df.schema.fields]
    for name, section, df in reports:
        if name not in tables:
            tables[name], first[name] = df, section
        elif shape(tables[name]) != shape(df):
            raise ValueError(
                f"sections {first[name]!r} and {section!r} both write {name!r}, with different columns or types"
            )
        else:
            tables[name] = tables[name].unionByName(df)
    return tables


@dataclass
class RunResult:
    completeness: DataFrame | None = None
    timeliness: DataFrame | None = None
    accuracy: list = field(default_factory=list)  # (result table name, section name, DataFrame)
    profile: DataFrame | None = None  # failing values as rows, with ``profile=True``
    rate: DataFrame | None = None
    reconciliation: list = field(default_factory=list)  # as ``accuracy``
    availability: DataFrame | None = None

    def accuracy_tables(self) -> dict[str, DataFrame]:
        """Result table name -> the rows of all reports that go to it.  Sections may share
        a table if their reports have the same columns and types; otherwise this raises."""
        return _by_table(self.accuracy)

    def tables(self, timeliness_table: str | None = None, completeness_table: str = COMPLETENESS_TABLE) -> dict:
        """Every result table by name; raises where two results cannot go to one table."""
        named = [
            (completeness_table, self.completeness), (timeliness_table, self.timeliness), (PROFILE_TABLE, self.profile),
            (RATE_TABLE, self.rate), (AVAILABILITY_TABLE, self.availability),
            *self.accuracy_tables().items(), *_by_table(self.reconciliation).items(),
        ]
        named = [(n, df) for n, df in named if n and df is not None]
        twice = sorted({n for n, _ in named if [m for m, _ in named].count(n) > 1})
        if twice:
            raise ValueError(f"two results are both to be written to {twice}")
        return dict(named)


def _union(frames: list[DataFrame]) -> DataFrame | None:
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else None


def _filtered(df: DataFrame, rows: Filter, as_of, extensions) -> DataFrame:
    """The rows that a catalog's filter names, as far as the run honours it.  The conditions
    stand directly above the scan: dates prune partitions, the rest is pushed to the files."""
    if "date_checked" in extensions and rows.day is not None and rows.date_column:
        df = df.where(checked_day(df, rows.date_column, rows.day, as_of))
    if "additional_filter" in extensions and rows.condition:
        df = df.where(rows.condition)
    return df


def _reads(sec: Section, role: str, side: str, measures) -> list[str]:
    """SQL expressions over the columns that the section's measures read from a table."""
    out = []
    columns = lambda *names: [sql_ident(n) for n in names if n]
    conditions = lambda rows: columns(rows.date_column) + ([f"({closed(rows.condition)})"] if rows.condition else [])
    if role == side:
        if sec.completeness and ("completeness" in measures or "rate" in measures):
            out += [f"({closed(r)})" for r in sec.completeness] + columns(*(r.target for r in sec.completeness))
            out += conditions(sec.completeness_filter)
        if sec.timeliness and ("timeliness" in measures or "availability" in measures):
            out += columns(sec.timeliness.date_column)
    if sec.accuracy and sec.source and sec.target and ("accuracy" in measures or "reconciliation" in measures):
        acc = sec.accuracy
        if role == "source":
            out += columns(*acc.keys, *(r.source_col for r in acc.rules)) + conditions(acc.source_filter)
        else:
            out += columns(*(r.target_col for r in acc.rules)) + conditions(acc.target_filter)
            out += columns(*(acc.target_keys or acc.keys))
    return out


def run(
    sections: list[Section],
    resolver,
    as_of=None,
    side: str = "target",
    measures=("completeness", "timeliness", "accuracy"),
    invalid: str | None = None,
    stage_inputs: bool | None = None,
    spark: SparkSession | None = None,
    profile: bool | None = None,
    report_options: dict | None = None,
    label: str = NULL_LABEL,
    extensions=(),
) -> RunResult:
    """Build the plans of every measure of every section.

    ``measures`` are any of :data:`MEASURES`: ``rate`` is the completeness rate,
    ``reconciliation`` one row per key, ``availability`` the intervals of a span (for
    sections that declare ``check_avaibility_until``).

    By default a completeness scorecard is its counts, and the failing values are rows of
    a table of their own (``profile``: database, table, column_name, value, count): both come
    from one scan, and counts never wait for a text.  ``invalid="json"`` (or
    ``"distinct"``) makes the scorecard carry one text per rule instead, a cell of at
    most 2 GB; ``profile`` then is off unless asked for.

    ``stage_inputs`` writes the columns that are read of each table once to the shared folder
    before it is measured, so a source that should not be read once per measure (a
    database) is read once and every plan reads the files.  The default
    (``None``) stages exactly when the resolver is :class:`JdbcTables`.
    Staging needs the session (``spark``, or the JDBC resolver's own).

    ``extensions`` (of :data:`EXTENSIONS`, or ``"all"``) are the declared catalog keys that this run
    honours; ``join_type`` and ``target_filter`` apply to reconciliations.  ``report_options`` go
    to every accuracy report, ``label`` stands for NULL among failing values.
    """
    if side not in ("target", "source"):
        raise ValueError("side must be 'target' or 'source'")
    extensions = set(EXTENSIONS if extensions == "all" else extensions)
    for what, known in ((set(measures), MEASURES), (extensions, EXTENSIONS)):
        if what - set(known):
            raise ValueError(f"unknown {sorted(what - set(known))}; expected some of {known}")
    if profile is None:
        profile = invalid is None
    if stage_inputs is None:
        stage_inputs = isinstance(resolver, JdbcTables)
    if spark is None and isinstance(resolver, JdbcTables):
        spark = resolver.spark
    key_of = lambda ref: (ref.database, ref.table, repr(sorted(ref.options.items())))
    for sec in sections:
        for name, ref in sec.lookups.items():
            resolve(resolver, ref).createOrReplaceTempView(name)
    reads: dict = {}
    for sec in sections:
        for role, ref in (("source", sec.source), ("target", sec.target)):
            if ref is not None:
                reads.setdefault(key_of(ref), []).extend(_reads(sec, role, side, measures))
    loaded: dict = {}

    def table(ref):
        if ref is None:
            return None
        key = key_of(ref)
        if key not in loaded:
            df = resolve(resolver, ref)
            if stage_inputs:
                if spark is None:
                    raise ValueError("stage_inputs needs the session")
                if reads[key]:
                    df = df.select(*[F.col(sql_ident(c)) for c in used_columns(df, reads[key])])
                df = stage(df, spark, f"{ref.database}.{ref.table}")
            loaded[key] = df
        return loaded[key]

    cards, profiles, times, rates, spans = [], [], [], [], []
    result = RunResult()
    for sec in sections:
        ref = sec.target if side == "target" else sec.source
        df = table(ref)
        if sec.completeness and df is not None and ("completeness" in measures or "rate" in measures):
            rows = _filtered(df, sec.completeness_filter, as_of, extensions)
            place = [F.lit(ref.database).cast("string").alias("database"), F.lit(ref.table).cast("string").alias("table")]
            if "rate" in measures:
                rates.append(completeness_rate(rows, sec.completeness).select(*place, "*"))
            if "completeness" in measures:
                kept = None
                if profile:
                    kept = kept_profile(rows, sec.completeness, label, f"{sec.name}-profile")
                    profiles.append(profile_rows(kept, sec.completeness).select(*place, "*"))
                if kept is not None and invalid is None:
                    cards.append(profile_counts(kept, sec.completeness, ref.database, ref.table))
                else:
                    cards.append(scorecard(rows, sec.completeness, ref.database, ref.table, label, invalid, kept))
        if sec.timeliness and df is not None:
            tl = sec.timeliness
            if "timeliness" in measures:
                times.append(timeliness(df, tl.date_column, tl.offset_days, as_of, ref.database, ref.table))
            if "availability" in measures and tl.until is not None:
                spans.append(availability(df, tl.date_column, tl.until, tl.offset_days, tl.unit, as_of,
                                          ref.database, ref.table))
        if sec.accuracy and sec.source is not None and sec.target is not None:
            acc = sec.accuracy
            if "accuracy" in measures or "reconciliation" in measures:
                source = _filtered(table(sec.source), acc.source_filter, as_of, extensions)
                target = _filtered(table(sec.target), acc.target_filter, as_of, extensions)
            if "accuracy" in measures:
                report = accuracy_report(source, target, acc.keys, acc.rules, **(report_options or {}))
                result.accuracy.append((accuracy_table(sec.source.table, sec.target.table), sec.name, report))
            if "reconciliation" in measures:
                how = join_type(acc.join) if "join_type" in extensions else "inner"
                theirs = acc.target_keys if "target_filter" in extensions else None
                if how == "inner" and theirs in (None, acc.keys):
                    report = reconcile(source, target, acc.keys, acc.rules)
                else:
                    report = reconcile_outer(source, target, acc.keys, acc.rules, theirs, how)
                name = reconciliation_table(sec.source.table, sec.target.table)
                result.reconciliation.append((name, sec.name, report))
    result.completeness, result.profile, result.timeliness = _union(cards), _union(profiles), _union(times)
    result.rate, result.availability = _union(rates), _union(spans)
    return result


def write(result: RunResult, sink, timeliness_table: str | None = None, run_id: str | None = None,
          completeness_table: str = COMPLETENESS_TABLE) -> None:
    """Append every result to its table: one append per table for all sections; timeliness only
    when a table is named.

    All tables are checked before the first append.  A sink with runs (:class:`PathSink`,
    :class:`JdbcSink`) shows all tables in one step at the end; with a ``run_id`` of the
    caller a run that failed can be written again, and one that was published is left alone.
    """
    tables = result.tables(timeliness_table, completeness_table)
    if not tables:
        return
    if not hasattr(sink, "publish"):
        for name, df in tables.items():
            sink.append(df, name)
        return
    spark = next(iter(tables.values())).sparkSession
    if run_id is not None and sink.published(spark, run_id):
        return
    run_id = run_id or new_run_id()
    for name, df in tables.items():
        sink.append(df, name, run_id)
    sink.publish(spark, run_id, list(tables))
