"""Helpers for SQL expression text.

Expressions are passed around as SQL text and handed to Spark in one ``selectExpr`` per step.
A wide projection built from hundreds of Column objects costs seconds of driver time, since
each one is a call into the JVM; as text it is one call, and Catalyst sees the same plan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame


def name(column: str) -> str:
    """A column name, quoted for SQL."""
    return "`" + column.replace("`", "``") + "`"


def names(columns: Iterable[str]) -> str:
    return ", ".join(name(c) for c in columns)


def literal(value: str | int | float | dt.date | dt.datetime | None) -> str:
    if value is None:
        return "null"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, dt.datetime):
        # Spark hands instants to Python in local time without a zone; state the zone when going back.
        return f"timestamp'{value.astimezone(dt.timezone.utc).isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"date'{value.isoformat()}'"
    if isinstance(value, float):
        return f"{value!r}D"
    return str(value)


def literals(values: Iterable) -> str:
    return ", ".join(literal(v) for v in values)


def aliased(columns: Mapping[str, str]) -> list[str]:
    return [f"{expression} as {name(alias)}" for alias, expression in columns.items()]


def with_exprs(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add or replace columns, all read from ``df`` as it was; one projection."""
    kept = [f"{columns[c]} as {name(c)}" if c in columns else name(c) for c in df.columns]
    added = {alias: expression for alias, expression in columns.items() if alias not in set(df.columns)}
    return df.selectExpr(*kept, *aliased(added))


def computed_once(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``with_exprs`` for costly expressions that several later expressions or filters read.

    The values pass through a generator. Spark copies a plain projected expression into every
    filter above it, so a parsed payload read by 70 rules would be parsed 70 times per row.
    """
    fields = ", ".join(f"{literal(alias)}, {expression}" for alias, expression in columns.items())
    kept = [c for c in df.columns if c not in columns]
    made = df.selectExpr(*map(name, kept), f"inline(array(named_struct({fields})))")
    order = [*df.columns, *[c for c in columns if c not in set(df.columns)]]
    return made.selectExpr(*map(name, order))
