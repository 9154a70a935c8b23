"""vigil - configuration-driven data-quality measures as Spark DataFrame plans.

Completeness (rule violations, scorecards, failing-value profiles),
timeliness (rows delivered for the expected day) and accuracy (per-key
aggregates of a source and a target compared against thresholds), driven by
YAML rule catalogs or by code.  Every measure returns a DataFrame and runs no
action.
"""

from vigil.functions.rules import Rule
from vigil.operators.accuracy import (
    AccuracyRule,
    accuracy_by_key,
    accuracy_report,
    expansion_partitions,
    join_key_rows,
    reconcile,
    rule_check,
)
from vigil.operators.completeness import (
    completeness_rate,
    invalid_distinct_values,
    invalid_profile_json,
    invalid_value_profile,
    scorecard,
    violations,
)
from vigil.operators.timeliness import timeliness
from vigil.plans.catalog import Section, TableRef, load_catalog, load_catalogs, parse_catalog
from vigil.plans.runner import RunResult, run, write

__all__ = [
    "AccuracyRule",
    "Rule",
    "RunResult",
    "Section",
    "TableRef",
    "accuracy_by_key",
    "accuracy_report",
    "completeness_rate",
    "expansion_partitions",
    "invalid_distinct_values",
    "invalid_profile_json",
    "invalid_value_profile",
    "join_key_rows",
    "load_catalog",
    "load_catalogs",
    "parse_catalog",
    "reconcile",
    "rule_check",
    "run",
    "scorecard",
    "timeliness",
    "violations",
    "write",
]
