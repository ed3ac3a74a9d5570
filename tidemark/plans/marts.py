"""Marts over the offers fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import metrics
from tidemark.functions import scalars as fn
from tidemark.functions.text import aliased, literal
from tidemark.operators.ranking import rank_rows, top_one


def current(fact: DataFrame) -> DataFrame:
    return fact.filter(fn.is_open("valid_to"))


def available(fact: DataFrame) -> DataFrame:
    """Open, free to rent, verified offers with usable power, price and compute figures."""
    figures = ("total_system_tflops", "revenue_usd_per_hr", "gpu_tdp_watts")
    conditions = [*map(fn.positive, figures), "not rented_flag", "rentable_flag", "verification_flag = 'verified'"]
    return current(fact).filter(" and ".join(conditions))


def opportunities(fact: DataFrame) -> DataFrame:
    """Available offers ranked within their offer type; the row key breaks ties."""
    order = [
        "profit_per_tflop_business_high_usd desc", "reliability_score desc", "gpu_tdp_watts asc",
        "pcie_bandwidth_gbytes_per_sec desc", "gpu_bandwidth_gbytes_per_sec desc", "valid_from desc", "offer_id asc",
    ]
    shown = [
        *fixed.OPPORTUNITY_ATTRIBUTES,
        *metrics.scenario_names(metrics.PROFIT),
        *metrics.scenario_names(metrics.PROFIT_PER_TFLOP),
        "valid_from",
    ]
    # Ranking stores its rows, so only what is shown or ordered by goes in.
    needed = dict.fromkeys([*shown, *[o.split()[0] for o in order]])
    rows = available(fact).select(*[c for c in needed if c != "arbitrage_rank"])
    return rank_rows(rows, ["offer_type"], order, "arbitrage_rank").select(*shown)


def best_offers(fact: DataFrame) -> DataFrame:
    """The latest, then most profitable available offer of each GPU variant, per GPU."""
    variant = ["offer_type", "gpu_architecture", "gpu_model_name", "gpu_memory_gb"]
    profit_per_gpu = fn.safe_ratio("profit_business_high_usd_per_hr", "number_of_gpus")
    best = top_one(available(fact), variant, ["valid_from desc", f"{profit_per_gpu} desc", "offer_id asc"])
    return best.selectExpr(
        *fixed.BEST_OFFER_ATTRIBUTES,
        *aliased(metrics.per_gpu()),
        *metrics.scenario_names(metrics.PROFIT_PER_TFLOP),
        "valid_from",
    )


def model_summary(fact: DataFrame) -> DataFrame:
    """Counts, averages and profitability shares of the open rows of each GPU variant."""
    shares = {f"pct_profitable_{s}": f"{metrics.PROFIT.format(s)} > 0" for s in fixed.SCENARIOS}
    shares |= {"pct_verified": "verification_flag = 'verified'", "pct_available": "not rented_flag"}
    measures = {
        "total_offer_observations": "count(*)",
        "avg_kwh_per_tflop": "avg(kwh_per_tflop)",
        "avg_revenue_per_gpu_usd_per_hr": f"avg({fn.safe_ratio('revenue_usd_per_hr', 'number_of_gpus')})",
        **{column: fn.percent_true(condition) for column, condition in shares.items()},
        "avg_reliability_score": "avg(reliability_score)",
        "last_seen_at": "max(valid_from)",
    }
    return current(fact).groupBy(*fixed.SUMMARY_KEYS).agg(*map(F.expr, aliased(measures)))


def _trend_rows(fact: DataFrame, schedule_dim: DataFrame, tz: str | None) -> DataFrame:
    """Fact rows with their hour, tariff window and measures.

    Tariff hours are looked up in UTC, or in ``tz`` when given. Weekday and hour are equality
    keys; the date range is a residual over the few versions a weekday-hour has.
    """
    local = "valid_from" if tz is None else f"from_utc_timestamp(valid_from, {literal(tz)})"
    hours = schedule_dim.selectExpr(
        "day_of_week as s_day", "hour as s_hour", "tariff_type as tariff_window",
        "valid_from as s_from", "valid_to as s_to",
    )
    # Only what the measures need enters the join and the grouping.
    timed = fact.selectExpr(
        f"{fn.hour_bucket('valid_from')} as hour_bucket", f"{fn.iso_weekday(local)} as day_of_week",
        f"{fn.hour_of_day(local)} as hour_of_day", f"to_date({local}) as _day",
        *fixed.TREND_KEYS, "revenue_usd_per_hr", *_MEASURED,
    )
    on = "day_of_week = s_day and hour_of_day = s_hour and _day >= s_from and _day < s_to"
    return timed.join(hours, F.expr(on), "left")


_MEASURED = [c for pattern in (metrics.PROFIT, metrics.PROFIT_PER_TFLOP) for c in metrics.scenario_names(pattern)]
_GROUP = ["hour_bucket", "day_of_week", "hour_of_day", "tariff_window", *fixed.TREND_KEYS]


def trends(fact: DataFrame, schedule_dim: DataFrame, tz: str | None = None) -> DataFrame:
    """Hourly profit statistics of all fact rows per GPU variant and tariff window."""
    stats = {"offer_count": "count(*)", "avg_revenue_usd_per_hr": "avg(revenue_usd_per_hr)"}
    for pattern in (metrics.PROFIT, metrics.PROFIT_PER_TFLOP):
        for stat in ("avg", "min", "max"):
            stats |= {f"{stat}_{c}": f"{stat}({c})" for c in metrics.scenario_names(pattern)}
    return _trend_rows(fact, schedule_dim, tz).groupBy(*_GROUP).agg(*map(F.expr, aliased(stats)))


# Statistics of groups that can be merged: averages as sums and counts of what is not null.
_MERGED = {"sum": "sum", "n": "sum", "min": "min", "max": "max"}


def _partial_columns() -> dict[str, tuple[str, str]]:
    """Column of the partials -> (statistic, measure)."""
    columns = {f"{stat}_revenue_usd_per_hr": (stat, "revenue_usd_per_hr") for stat in ("sum", "n")}
    return columns | {f"{stat}_{c}": (stat, c) for stat in _MERGED for c in _MEASURED}


def trend_partials(fact: DataFrame, schedule_dim: DataFrame, tz: str | None = None) -> DataFrame:
    """Mergeable statistics of the groups of ``trends``."""
    made = {name: f"{'count' if stat == 'n' else stat}({c})" for name, (stat, c) in _partial_columns().items()}
    return _trend_rows(fact, schedule_dim, tz).groupBy(*_GROUP).agg(*map(F.expr, aliased({"offer_count": "count(*)", **made})))


def merge_partials(partials: DataFrame, keys: Sequence[str] = tuple(_GROUP)) -> DataFrame:
    """One row per group from several partial ones. With fewer ``keys``, the statistics of coarser groups."""
    merged = {name: f"{_MERGED[stat]}({name})" for name, (stat, _) in _partial_columns().items()}
    return partials.groupBy(*keys).agg(*map(F.expr, aliased({"offer_count": "sum(offer_count)", **merged})))


def trends_of(partials: DataFrame, also: Sequence[str] = (), keys: Sequence[str] = tuple(_GROUP)) -> DataFrame:
    """``trends`` as a projection of its partials."""
    shown = {"avg_revenue_usd_per_hr": "sum_revenue_usd_per_hr / nullif(n_revenue_usd_per_hr, 0)"}
    for pattern in (metrics.PROFIT, metrics.PROFIT_PER_TFLOP):
        shown |= {f"avg_{c}": f"sum_{c} / nullif(n_{c}, 0)" for c in metrics.scenario_names(pattern)}
        shown |= {f"{stat}_{c}": f"{stat}_{c}" for stat in ("min", "max") for c in metrics.scenario_names(pattern)}
    return partials.selectExpr(*keys, "offer_count", *aliased(shown), *also)
