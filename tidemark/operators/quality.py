"""Declarative data checks: one pass over a table for all row checks, one grouping per key set."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import literal, literals

ERROR, WARN = "error", "warn"


class QualityError(Exception):
    """Raised by the gate when a check of error severity has failures."""


@dataclass(frozen=True)
class Checks:
    """Checks of one table.

    ``holds`` maps a condition with ``{c}`` for the column to the columns it is declared on;
    ``row_holds`` are whole conditions. Unknown (null) conditions pass.
    ``unique`` ignores nulls, ``unique_keys`` groups them.
    """

    not_null: Sequence[str] = ()
    not_null_warn: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    accepted_warn: Mapping[str, Sequence[str]] = field(default_factory=dict)
    holds: Mapping[str, Sequence[str]] = field(default_factory=dict)
    holds_warn: Mapping[str, Sequence[str]] = field(default_factory=dict)
    row_holds: Sequence[str] = ()
    unique: Sequence[str] = ()
    unique_keys: Sequence[Sequence[str]] = ()

    def row_rules(self, now: str = "current_timestamp()") -> list[tuple[str, str, str, str]]:
        """(check, target, severity, SQL condition of a failing row). ``now`` fills ``{now}``."""
        rules = []
        for severity, columns in ((ERROR, self.not_null), (WARN, self.not_null_warn)):
            rules += [("not_null", c, severity, f"{c} is null") for c in columns]
        for severity, values in ((ERROR, self.accepted), (WARN, self.accepted_warn)):
            rules += [
                ("accepted_values", c, severity, f"{c} not in ({literals(allowed)})") for c, allowed in values.items()
            ]
        for severity, conditions in ((ERROR, self.holds), (WARN, self.holds_warn)):
            for text, columns in conditions.items():
                rules += [
                    ("expression", text.format(c=c, now="now"), severity, f"not ({text.format(c=c, now=now)})")
                    for c in columns
                ]
        rules += [("expression", text, ERROR, f"not ({text})") for text in self.row_holds]
        return rules

    def key_rules(self) -> list[tuple[str, str, Sequence[str], bool]]:
        """(check, target, keys, whether null keys are left out)."""
        return [("unique", c, [c], True) for c in self.unique] + [
            ("unique_keys", ", ".join(keys), keys, False) for keys in self.unique_keys
        ]

    def __len__(self) -> int:
        return len(self.row_rules()) + len(self.key_rules())


def _report_row(table: str, check: str, target: str, severity: str, failures: str) -> str:
    return (
        f"named_struct('table_name', {literal(table)}, 'check_name', {literal(check)}, 'target', {literal(target)},"
        f" 'severity', {literal(severity)}, 'failures', cast({failures} as bigint))"
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], skip_nulls: bool = False) -> DataFrame:
    """Keys that occur more than once, with their count. Counts are combined before the shuffle."""
    rows = df.dropna(subset=list(keys)) if skip_nulls else df
    return rows.groupBy(*keys).count().withColumnRenamed("count", "copies").filter("copies > 1")


def run_checks(df: DataFrame, table: str, checks: Checks, now: str = "current_timestamp()") -> DataFrame:
    """One row per check: table_name, check_name, target, severity, failures."""
    parts = []
    rules = checks.row_rules(now)
    if rules:
        counts = df.selectExpr(*[f"count_if({cond}) as c{i}" for i, (*_, cond) in enumerate(rules)])
        rows = [_report_row(table, check, target, sev, f"c{i}") for i, (check, target, sev, _) in enumerate(rules)]
        parts.append(counts.selectExpr(f"inline(array({', '.join(rows)}))"))
    for check, target, keys, skip_nulls in checks.key_rules():
        found = duplicate_keys(df, keys, skip_nulls).selectExpr("count(*) as n")
        parts.append(found.selectExpr(f"inline(array({_report_row(table, check, target, ERROR, 'n')}))"))
    return reduce(DataFrame.unionByName, parts)


def merge_reports(reports: Sequence[DataFrame]) -> DataFrame:
    """The report of a whole table from those of its parts: failures add up.

    Right for row checks of any parts, and for key checks where equal keys share a part, as they do when parts are spans of one of the
    key's columns. So a load is checked by its own rows, and the reports of all loads tell what one of everything would.
    """
    every = reduce(DataFrame.unionByName, reports)
    keys = ["table_name", "check_name", "target", "severity"]
    return every.groupBy(*keys).agg(F.sum("failures").alias("failures"))


def singular_check(failing: DataFrame, table: str, check: str, severity: str = ERROR) -> DataFrame:
    """A check given as a frame of failing rows."""
    counted = failing.selectExpr("count(*) as n")
    return counted.selectExpr(f"inline(array({_report_row(table, 'singular', check, severity, 'n')}))")


def gate(report: DataFrame) -> list[str]:
    """Raise if an error check failed; return what the warnings found. Reads one row per failed check."""
    failed = report.filter("failures > 0").collect()
    lines = {
        sev: [f"{r.table_name}: {r.check_name} {r.target}: {r.failures}" for r in failed if r.severity == sev]
        for sev in (ERROR, WARN)
    }
    if lines[ERROR]:
        raise QualityError("; ".join(lines[ERROR]))
    return lines[WARN]
