"""Chart queries over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import fixed

PROFIT = "profit_business_high_usd_per_hr"
PROFIT_PER_GPU = "profit_business_high_per_gpu_usd_per_hr"
PROFIT_PER_TFLOP = "profit_per_tflop_business_high_usd"


def rate_by_type(summary: DataFrame) -> DataFrame:
    """Profitability rate by GPU model and offer type."""
    return summary.select(*fixed.SUMMARY_KEYS, *[f"pct_profitable_{s}" for s in fixed.SCENARIOS])


def best_profit(best: DataFrame) -> DataFrame:
    """Best current profit per GPU of each model."""
    return best.groupBy("gpu_model_name").agg(F.expr(f"max({PROFIT_PER_GPU}) as best_profit_per_gpu"))


def profit_over_time(trends: DataFrame) -> DataFrame:
    """Mean profit per hour and model, weighted by offers; groups without a profit carry no weight."""
    weight = f"case when avg_{PROFIT} is not null then offer_count end"
    return trends.groupBy("hour_bucket", "gpu_model_name").agg(
        F.expr("sum(offer_count) as offers"), F.expr(f"sum(avg_{PROFIT} * {weight}) / sum({weight}) as avg_profit")
    )


def heatmap(trends: DataFrame) -> DataFrame:
    """Mean profit by weekday and hour, one column per hour."""
    hours = list(range(24))
    pivoted = trends.groupBy("day_of_week").pivot("hour_of_day", hours).agg(F.expr(f"avg(avg_{PROFIT})"))
    return pivoted.withColumnsRenamed({str(h): f"h{h:02d}" for h in hours})


def risk_reward(opportunities: DataFrame) -> DataFrame:
    return opportunities.select("offer_id", "offer_type", "gpu_model_name", "reliability_score", PROFIT)


def profit_per_tflop(opportunities: DataFrame) -> DataFrame:
    return opportunities.groupBy("gpu_model_name").agg(
        F.expr(f"avg({PROFIT_PER_TFLOP}) as avg_profit_per_tflop"),
        F.expr(f"max({PROFIT_PER_TFLOP}) as max_profit_per_tflop"),
        F.expr("count(*) as offers"),
    )


def live_count(opportunities: DataFrame) -> DataFrame:
    return opportunities.selectExpr("count(*) as live_offers")
