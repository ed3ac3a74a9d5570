"""Energy, cost and profit expressions for every tariff scenario, generated from ``fixed.SCENARIOS``."""

from __future__ import annotations

from tidemark import fixed
from tidemark.functions.scalars import safe_ratio

COST = "cost_{}_usd_per_hr"
PROFIT = "profit_{}_usd_per_hr"
COST_PER_TFLOP = "cost_per_tflop_{}_usd"
PROFIT_PER_TFLOP = "profit_per_tflop_{}_usd"
PER_GPU = "{}_{}_per_gpu_usd_per_hr"


def scenario_names(pattern: str) -> list[str]:
    return [pattern.format(scenario) for scenario in fixed.SCENARIOS]


def energy() -> dict[str, str]:
    kwh = "gpu_tdp_watts * number_of_gpus / 1000.0D"
    return {
        "total_system_kwh_per_hr": kwh,
        "kwh_per_tflop": safe_ratio(kwh, "total_system_tflops"),
        "revenue_usd_per_hr": "total_price_usd_per_hr",
    }


def costs() -> dict[str, str]:
    """kWh times (tariff plus distribution fee), in USD. A missing fee leaves the cost null."""
    return {
        COST.format(scenario): safe_ratio(
            f"total_system_kwh_per_hr * ({code} + {fixed.DISTRIBUTION_FEE})", "usd_to_mkd_rate"
        )
        for scenario, code in fixed.SCENARIOS.items()
    }


def margins() -> dict[str, str]:
    """Profit, cost per TFLOP and profit per TFLOP, from the cost columns."""
    out = {PROFIT.format(s): f"revenue_usd_per_hr - {COST.format(s)}" for s in fixed.SCENARIOS}
    for pattern, amount in ((COST_PER_TFLOP, "{}"), (PROFIT_PER_TFLOP, "revenue_usd_per_hr - {}")):
        for s in fixed.SCENARIOS:
            out[pattern.format(s)] = safe_ratio(amount.format(COST.format(s)), "total_system_tflops")
    return out


def per_gpu() -> dict[str, str]:
    """Revenue, then cost and profit per scenario, each divided by the GPU count."""
    out = {"revenue_per_gpu_usd_per_hr": safe_ratio("revenue_usd_per_hr", "number_of_gpus")}
    for kind, pattern in (("cost", COST), ("profit", PROFIT)):
        out |= {PER_GPU.format(kind, s): safe_ratio(pattern.format(s), "number_of_gpus") for s in fixed.SCENARIOS}
    return out
