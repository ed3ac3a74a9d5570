"""Dimensions with history, and the offers fact."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import metrics
from tidemark.functions.text import aliased, literal, name, with_exprs
from tidemark.operators.incremental import close_absent
from tidemark.operators.intervals import changes_only, interval_join, scd2

RATE_KEYS = ("from_currency", "to_currency")


def dim_rates(rates: DataFrame, gap_days: int = 1, chunk: str | None = None) -> DataFrame:
    """Change-only history of each currency pair."""
    changed = changes_only(rates, RATE_KEYS, "timestamp", "value", chunk=chunk)
    versions = scd2(changed, RATE_KEYS, "timestamp", [*RATE_KEYS, "value", "timestamp"], gap_days, chunk=chunk)
    return versions.select("skey", *RATE_KEYS, "value", "inverse_value", "valid_from", "valid_to", "is_latest")


def dim_tiers(tiers: DataFrame, gap_days: int = 1) -> DataFrame:
    """A description has one version per day at most, so plain windows hold few rows per key."""
    key = "tariff_description_mk"
    versions = scd2(tiers, [key], "valid_from", [key, "valid_from"], gap_days)
    return versions.select(
        "skey", "tariff_type", "tariff_description_en", key, "price_mkd_per_kwh", "valid_from", "valid_to", "is_latest"
    )


def dim_schedule(schedule: DataFrame, gap_days: int = 1) -> DataFrame:
    """A weekday-hour has one version per day at most, as above."""
    keys = ["day_of_week", "hour"]
    versions = scd2(schedule, keys, "valid_from", [*keys, "valid_from"], gap_days)
    return versions.select("skey", *keys, "tariff_type", "valid_from", "valid_to", "is_latest")


def tiers_by_code(dim: DataFrame, by: tuple[str, ...] = ("valid_from", "valid_to")) -> DataFrame:
    """Tariff prices as one column per code. The codes are given, so no job runs to find them."""
    codes = list(fixed.TARIFF_CODES.values())
    return dim.groupBy(*by).pivot("tariff_description_en", codes).agg(F.max("price_mkd_per_kwh"))


def tiers_as_of_changes(dim: DataFrame) -> DataFrame:
    """``tiers_by_code`` with one complete row per span between changes of any tariff.

    For tariffs that change on different days, where pivoting by each one's own interval
    gives partly empty rows that overlap.
    """
    starts = dim.select("valid_from").distinct()
    spans = scd2(starts.selectExpr("valid_from", "0 as _all"), ["_all"], "valid_from", ["valid_from"], gap_days=0)
    spans = spans.selectExpr("valid_from as span_from", "valid_to as span_to")
    covering = interval_join(spans, dim, "span_from", how="inner")
    pivoted = tiers_by_code(covering, ("span_from", "span_to"))
    return pivoted.withColumnsRenamed({"span_from": "valid_from", "span_to": "valid_to"})


def fact_offers(
    offers: DataFrame, rates_dim: DataFrame, tiers_dim: DataFrame,
    from_currency: str = fixed.FROM_CURRENCY, to_currency: str = fixed.TO_CURRENCY, tiers_per_span: bool = False,
) -> DataFrame:
    """Offers priced with the rate and tariffs of their day, and all scenario metrics."""
    pair = f"from_currency = {literal(from_currency)} and to_currency = {literal(to_currency)}"
    rates = rates_dim.filter(pair).selectExpr(
        "skey as exchange_rate_skey", "value as usd_to_mkd_rate", "valid_from as rate_from", "valid_to as rate_to"
    )
    tiers = tiers_as_of_changes(tiers_dim) if tiers_per_span else tiers_by_code(tiers_dim)
    tiers = tiers.withColumnsRenamed({"valid_from": "tier_from", "valid_to": "tier_to"})

    day = "to_date(valid_from)"
    priced = interval_join(offers, rates, day, "rate_from", "rate_to")
    priced = interval_join(priced, tiers, day, "tier_from", "tier_to")
    measured = with_exprs(with_exprs(priced, metrics.energy()), metrics.costs())
    return measured.selectExpr(
        *map(name, [*fixed.FACT_ATTRIBUTES, *metrics.scenario_names(metrics.COST)]), *aliased(metrics.margins())
    )


def close_single_load(fact: DataFrame, latest: Any, latest_ids: DataFrame) -> DataFrame:
    """The fact after one load: rows whose ``offer_id`` the latest poll lacks are closed at that poll."""
    return close_absent(fact, latest, latest_ids)
