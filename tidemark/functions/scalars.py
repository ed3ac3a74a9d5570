"""Scalar functions as SQL text. All compile to generated code: no UDFs, no lambdas over arrays."""

from __future__ import annotations

from collections.abc import Sequence

from tidemark import fixed
from tidemark.functions.text import literal, literals

NULL_KEY_MARK = "_dbt_utils_surrogate_key_null_"  # fixed value: part of every published key


def utc_timestamp(value: str) -> str:
    """Instant from text or timestamp; sessions run in UTC, so zone-less text reads as UTC."""
    return f"cast({value} as timestamp)"


def safe_ratio(numerator: str, divisor: str) -> str:
    """``numerator / divisor``, null when the divisor is zero."""
    return f"({numerator}) / nullif({divisor}, 0)"


def inverse(value: str) -> str:
    return safe_ratio("1.0D", value)


def mb_to_gb(value: str) -> str:
    # A double literal: plain 1024.0 would turn whole numbers into decimals.
    return f"({value}) / 1024.0D"


def to_whole(value: str) -> str:
    """Float to 64-bit integer, half away from zero. A bare cast would truncate."""
    return f"cast(round({value}) as bigint)"


def blank_to_null(value: str) -> str:
    return f"nullif(trim({value}), '')"


def country_code(value: str) -> str:
    """Second comma-separated part, trimmed; null when missing or blank."""
    return blank_to_null(f"get(split({value}, ','), 1)")


def tariff_type(value: str) -> str:
    """high / low by the last space-separated word of a tariff description, else null."""
    last_word = f"element_at(split({value}, ' '), -1)"
    return (
        f"case when {last_word} in ({literals(fixed.HIGH_TARIFF_WORDS)}) then 'high'"
        f" when {last_word} in ({literals(fixed.LOW_TARIFF_WORDS)}) then 'low' end"
    )


def tariff_code(value: str) -> str:
    """Code of a tariff description by exact match; a CASE, no lookup join."""
    arms = " ".join(f"when {literal(text)} then {literal(code)}" for text, code in fixed.TARIFF_CODES.items())
    return f"case {value} {arms} else {literal(fixed.UNKNOWN_TARIFF)} end"


def nearest_size(value: str, sizes: Sequence[int] = fixed.GPU_MEMORY_SIZES_MB) -> str:
    """Nearest of the ascending ``sizes``; a tie takes the lower one.

    Nearest means: the first size whose midpoint to its successor is not below the value.
    As a CASE over midpoints it compiles, while an array search would be interpreted per row.
    """
    arms = " ".join(f"when {value} <= {literal((a + b) / 2)} then {a}" for a, b in zip(sizes, sizes[1:]))
    return f"case when {value} is null then null {arms} else {sizes[-1]} end"


def surrogate_key(*values: str) -> str:
    """md5 over the dash-joined text of the values; a null is marked, so it differs from ''."""
    parts = ", ".join(f"coalesce(cast({v} as string), {literal(NULL_KEY_MARK)})" for v in values)
    return f"md5(concat_ws('-', {parts}))"


def iso_weekday(value: str) -> str:
    """Monday 1 to Sunday 7."""
    return f"cast(weekday({value}) + 1 as bigint)"


def hour_of_day(value: str) -> str:
    return f"cast(hour({value}) as bigint)"


def hour_bucket(value: str) -> str:
    return f"date_trunc('hour', {value})"


def is_open(valid_to: str) -> str:
    return f"cast({valid_to} as date) = {literal(fixed.OPEN_DATE)}"


def positive(value: str) -> str:
    """True when above zero; null counts as zero."""
    return f"coalesce({value}, 0) > 0"


def percent_true(condition: str) -> str:
    """Share of rows where the condition holds, 0 to 100 with 2 decimals; null counts as false."""
    return f"round(100.0D * count_if({condition}) / count(*), 2)"
