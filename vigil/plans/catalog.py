"""Rule catalogs: YAML configuration -> typed sections.

A catalog file maps section names to sections; only names starting with
``dq_`` are sections (other top-level keys hold YAML anchors such as shared
connection settings, merged into sections with ``<<:``).  A section is::

    dq_<name>:
      source: {database: ..., table: ..., <reader options>}   # optional
      target: {database: ..., table: ..., <reader options>}   # optional
      measure:
        timeliness:   {date_column: c, expected_delivery: "days:-1"}
        completeness: {dq_rules: {<column>: "<SQL predicate>", ...}}
        accuracy:
          source_filter: {groupby: "k1,k2"}
          dq_rules:
            <rule name>: {source_cols: c, target_cols: c, aggfunc: max|sum, threshold: 0.02}

A completeness rule may also be written ``<name>: {rule: "<predicate>", column: c}``
so one column can carry several rules, or ``{listed_in: "SELECT ...", column: c}``: the
column's values must be in the one column of that query, which is looked up by a join.
``lookups: {name: {database: ..., table: ...}}`` of a section names the tables that its
rules' subqueries read; a run registers them as views under those names.

Keys that catalogs declare without a defined meaning have one of our own, used only when
a run asks for it (``run(..., extensions=...)``), so that results are the same without:

* ``date_checked`` (with ``date_column``, under completeness, ``source_filter`` and
  ``target_filter``): only rows of that day are measured;
* ``additional_filter`` (under ``source_filter`` and ``target_filter``): a further condition;
* ``target_filter.groupby``: the target's key columns, matched to the source's by position;
* ``join_type``: which keys a reconciliation keeps;
* ``check_avaibility_until``, ``interval_unit`` (timeliness): availability over a span.

``date_format`` is checked against the one text format that dates have, ``%Y-%m-%d``; other
keys are kept in ``extra``.

Parsing happens once on the driver; the catalog is configuration, not data.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

import yaml

from vigil.functions.dates import parse_offset
from vigil.functions.rules import Rule, listed_in
from vigil.operators.accuracy import as_accuracy_rules, join_type, parse_keys

SECTION_PREFIX = "dq_"

#: The format of dates in text columns, as catalogs write it.
DATE_FORMAT = "%Y-%m-%d"

#: Table-reference keys that are not reader options.
_REF_KEYS = {"database", "table"}


@dataclass(frozen=True)
class TableRef:
    database: str | None
    table: str
    options: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def qualified(self) -> str:
        return f"{self.database}.{self.table}" if self.database else self.table


@dataclass(frozen=True)
class Filter:
    """Rows of one day (``as_of + day``, of ``date_column``) that also meet ``condition``."""

    date_column: str | None = None
    day: int | None = None
    condition: str | None = None


@dataclass(frozen=True)
class Timeliness:
    date_column: str
    offset_days: int
    until: int | None = None  # availability from as_of + until on
    unit: str = "days"
    extra: dict = field(default_factory=dict, hash=False, compare=False)


@dataclass(frozen=True)
class Accuracy:
    keys: list
    rules: list  # of vigil.operators.accuracy.AccuracyRule
    target_keys: list | None = None
    join: str = "inner"
    source_filter: Filter = Filter()
    target_filter: Filter = Filter()
    extra: dict = field(default_factory=dict, hash=False, compare=False)


@dataclass(frozen=True)
class Section:
    name: str
    source: TableRef | None = None
    target: TableRef | None = None
    timeliness: Timeliness | None = None
    completeness: list = field(default_factory=list)  # Rule
    accuracy: Accuracy | None = None
    completeness_filter: Filter = Filter()
    lookups: dict = field(default_factory=dict, hash=False, compare=False)  # view name -> TableRef


def _table_ref(spec) -> TableRef | None:
    if spec is None:
        return None
    if not isinstance(spec, dict) or "table" not in spec:
        raise ValueError(f"a source/target needs at least 'table': {spec!r}")
    opts = {k: v for k, v in spec.items() if k not in _REF_KEYS}
    return TableRef(spec.get("database"), str(spec["table"]), opts)


def _completeness_rules(spec: dict) -> list[Rule]:
    rules = []
    for name, body in (spec.get("dq_rules") or {}).items():
        if isinstance(body, dict) and "listed_in" in body:
            column = body.get("column")
            rules.append(Rule(str(name), listed_in(str(column or name), str(body["listed_in"])), column))
        elif isinstance(body, dict):
            rules.append(Rule(str(name), str(body["rule"]), body.get("column")))
        else:
            rules.append(Rule(str(name), str(body)))
    return rules


def _filter(spec: dict | None) -> Filter:
    spec = spec or {}
    day = spec.get("date_checked")
    if spec.get("date_format") not in (None, DATE_FORMAT):
        raise ValueError(f"dates are read as {DATE_FORMAT}, not {spec['date_format']!r}")
    return Filter(spec.get("date_column"), None if day is None else parse_offset(day), spec.get("additional_filter"))


def parse_section(name: str, body: dict | None) -> Section:
    body = body or {}
    measure = body.get("measure") or {}
    tl = measure.get("timeliness")
    timeliness = None
    if tl:
        timeliness = Timeliness(
            date_column=str(tl["date_column"]),
            offset_days=parse_offset(tl.get("expected_delivery", "days:0")),
            until=parse_offset(tl["check_avaibility_until"]) if tl.get("check_avaibility_until") is not None else None,
            unit=str(tl.get("interval_unit") or "days"),
            extra={k: v for k, v in tl.items() if k not in ("date_column", "expected_delivery")},
        )
    comp = measure.get("completeness")
    completeness = _completeness_rules(comp) if comp else []
    acc = measure.get("accuracy")
    accuracy = None
    if acc:
        groupby = (acc.get("source_filter") or {}).get("groupby")
        if not groupby:
            raise ValueError(f"section {name}: accuracy needs source_filter.groupby")
        accuracy = Accuracy(
            keys=parse_keys(groupby),
            rules=as_accuracy_rules(acc.get("dq_rules") or {}),
            target_keys=parse_keys(theirs) if (theirs := (acc.get("target_filter") or {}).get("groupby")) else None,
            join=join_type(acc.get("join_type") or "inner"),
            source_filter=_filter(acc.get("source_filter")),
            target_filter=_filter(acc.get("target_filter")),
            extra={k: v for k, v in acc.items() if k not in ("source_filter", "dq_rules")},
        )
    return Section(
        name=name,
        source=_table_ref(body.get("source")),
        target=_table_ref(body.get("target")),
        timeliness=timeliness,
        completeness=completeness,
        accuracy=accuracy,
        completeness_filter=_filter(comp),
        lookups={str(k): _table_ref(v) for k, v in (body.get("lookups") or {}).items()},
    )


def parse_catalog(config: dict) -> list[Section]:
    """Sections of one parsed YAML document, in file order, ``dq_`` names only."""
    return [parse_section(k, v) for k, v in (config or {}).items() if str(k).startswith(SECTION_PREFIX)]


def load_catalog(path: str) -> list[Section]:
    with open(path) as fh:
        return parse_catalog(yaml.safe_load(fh))


def load_catalogs(folder: str, suffix: str = ".yml") -> list[Section]:
    """Every ``*.yml`` file of a folder (sorted by name; ``.yml.old`` and others skipped)."""
    sections = []
    for fname in sorted(os.listdir(folder)):
        if fname.endswith(suffix):
            sections += load_catalog(os.path.join(folder, fname))
    return sections
