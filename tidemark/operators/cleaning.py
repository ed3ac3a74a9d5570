"""Cleaning and typing operators. Each touches all its columns in one projection."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark import fixed
from tidemark.functions.text import literal, name, with_exprs
from tidemark.operators.ranking import top_one


def map_text(df: DataFrame, template: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace the named columns, by default every string column, by ``template`` with ``{c}`` filled in."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return with_exprs(df, {c: template.replace("{c}", name(c)) for c in columns}) if columns else df


def strip_non_ascii(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return map_text(df, r"regexp_replace({c}, r'[^\x00-\x7F]+', '')", columns)


def trim_spaces(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim spaces only; tabs and line breaks stay."""
    return map_text(df, "trim({c})", columns)


def empty_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return map_text(df, "nullif({c}, '')", columns)


def replace_pattern(df: DataFrame, column: str, pattern: str, replacement: str) -> DataFrame:
    return map_text(df, f"regexp_replace({{c}}, {literal(pattern)}, {literal(replacement)})", [column])


def strip_core_suffix(df: DataFrame, column: str = "cpu_model_name") -> DataFrame:
    """Drop a trailing core count such as `` 64-Core Processor``."""
    return replace_pattern(df, column, fixed.CORE_SUFFIX, "")


def decimal_comma_to_point(df: DataFrame, column: str = "price_mkd_per_kwh") -> DataFrame:
    return map_text(df, "replace({c}, ',', '.')", [column])


def parse_date(df: DataFrame, column: str, date_format: str, strict: bool = False) -> DataFrame:
    """Text to date; text in another form gives null, or raises when ``strict``."""
    function = "to_date" if strict else "try_to_date"
    return map_text(df, f"{function}({{c}}, {literal(date_format)})", [column])


def parse_valid_from(df: DataFrame) -> DataFrame:
    return parse_date(df, "valid_from", "dd.MM.yyyy")


def drop_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(f"{name(column)} is not null")


def deduplicate(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key.

    With ``order_by`` the row lowest in that order survives, so the result does not depend on
    partitioning. Both forms reduce before the shuffle: at most one row per key and task is
    moved, so a key holding a large share of the rows does not overload the task that gets it.
    """
    return top_one(df, keys, order_by) if order_by else df.dropDuplicates(list(keys))


def stamp_processed(df: DataFrame, clock: str = "current_timestamp()") -> DataFrame:
    """Add ``processed_at``; pass ``clock`` for a repeatable result."""
    return with_exprs(df, {"processed_at": clock})


def cast_to_schema(
    df: DataFrame, schema: T.StructType, permissive: bool = True, fill_missing: bool = False
) -> DataFrame:
    """Project to the declared columns and types; undeclared columns are dropped.

    A declared column the input lacks is left out, or added as null with ``fill_missing``.
    A value that does not fit becomes null, or raises when not ``permissive``.
    """
    present = set(df.columns)
    function = "try_cast" if permissive else "cast"
    out = []
    for f in schema.fields:
        source = name(f.name) if f.name in present else "null"
        if f.name in present or fill_missing:
            out.append(f"{function}({source} as {f.dataType.simpleString()}) as {name(f.name)}")
    return df.selectExpr(*out)


def apply_steps(df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df
