"""Declared checks of every table. Which columns carry which check, and its severity."""

from __future__ import annotations

from tidemark import fixed
from tidemark.functions import metrics
from tidemark.operators.quality import Checks

ABOVE_ZERO, NOT_NEGATIVE = "{c} > 0", "{c} >= 0"
WEEKDAY = "{c} >= 1 and {c} <= 7"
HOUR = "{c} >= 0 and {c} < 24"
PERCENT = "{c} >= 0 and {c} <= 100"
NOT_FUTURE_DAY, NOT_FUTURE = "{c} <= cast({now} as date)", "{c} <= {now}"
UPPER_CASE = "{c} = upper({c})"
ORDERED = "valid_from < valid_to"

_TYPE = {"tariff_type": ("low", "high")}
_CODE = {"tariff_description_en": tuple(fixed.TARIFF_CODES.values())}
_PAIR = {"from_currency": (fixed.FROM_CURRENCY,), "to_currency": (fixed.TO_CURRENCY,)}
_VERIFIED = {"verification_flag": fixed.VERIFICATION_FLAGS}
_OFFER = {"offer_type": fixed.OFFER_TYPES, **_VERIFIED}
_STAMPS = ("ingested_at", "processed_at")

_OFFER_IDS = ("offer_id", "machine_id", "host_id")
_OFFER_PRICES = (
    "total_price_usd_per_hr", "gpu_price_usd_per_hr", "deep_learning_score_per_usd", "minimum_bid_price_usd",
    "storage_cost_usd_per_hr", "network_upload_cost_usd_per_gbit", "network_download_cost_usd_per_gbit",
)
_OFFER_UNSIGNED = tuple(c for c in _OFFER_PRICES if c != "gpu_price_usd_per_hr")
_HOST = (
    "gpu_architecture", "gpu_model_name", "number_of_gpus", "gpu_bandwidth_gbytes_per_sec", "cpu_architecture",
    "number_of_cpu_cores", "disk_space_gb", "pcie_generation",
    "network_download_mbits_per_sec", "network_upload_mbits_per_sec", "reliability_score",
    "verification_flag", "rentable_flag", "rented_flag",
)
_HOST_ABOVE_ZERO = ("number_of_gpus", "disk_space_gb", "pcie_generation")
_HOST_WARN = ("gpu_tdp_watts", "cpu_model_name", "disk_model_name", "pcie_bandwidth_gbytes_per_sec", "deep_learning_score")
_RATE_WARN = (
    "gpu_bandwidth_gbytes_per_sec", "number_of_cpu_cores", "pcie_bandwidth_gbytes_per_sec",
    "network_download_mbits_per_sec", "network_upload_mbits_per_sec",
)
_COSTS = tuple(metrics.scenario_names(metrics.COST))
_COSTS_PER_TFLOP = tuple(metrics.scenario_names(metrics.COST_PER_TFLOP))

STAGING = {
    "stg_compute_offers": Checks(
        not_null=(*_OFFER_IDS, "offer_type", *_OFFER_PRICES, *_HOST, "gpu_memory_mb", "gpu_tflops", "ram_mb", *_STAMPS),
        not_null_warn=(*_HOST_WARN, "cpu_clock_speed_ghz", "disk_bandwidth_mbytes_per_sec"),
        accepted=_OFFER,
        holds={
            NOT_NEGATIVE: (*_OFFER_UNSIGNED, "reliability_score"),
            "{c} <= total_price_usd_per_hr": ("gpu_price_usd_per_hr",),
            ABOVE_ZERO: (*_HOST_ABOVE_ZERO, "gpu_memory_mb", "gpu_tflops"),
        },
        holds_warn={ABOVE_ZERO: (*_RATE_WARN, "cpu_clock_speed_ghz", "ram_mb", "disk_bandwidth_mbytes_per_sec")},
        unique_keys=(("offer_id", "ingested_at"),),
    ),
    "stg_electricity_tariff_tiers": Checks(
        not_null=("tariff_description", "price_mkd_per_kwh", "valid_from", *_STAMPS),
        holds={ABOVE_ZERO: ("price_mkd_per_kwh",), NOT_FUTURE_DAY: ("valid_from",)},
        unique_keys=(("tariff_description", "valid_from"),),
    ),
    "stg_electricity_tariff_schedule": Checks(
        not_null=("tariff_type", "day_of_week", "start_hour", "end_hour", "valid_from", *_STAMPS),
        accepted=_TYPE,
        holds={
            WEEKDAY: ("day_of_week",), HOUR: ("start_hour",), "{c} > 0 and {c} <= 24": ("end_hour",),
            NOT_FUTURE_DAY: ("valid_from",),
        },
        unique_keys=(("day_of_week", "start_hour", "end_hour", "valid_from"),),
    ),
    "stg_exchange_rates": Checks(
        not_null=("from_currency", "to_currency", "value", "timestamp", *_STAMPS),
        accepted=_PAIR,
        holds={ABOVE_ZERO: ("value",)},
        unique_keys=(("from_currency", "to_currency", "timestamp"),),
    ),
}

INTERMEDIATE = {
    "int_compute_offers": Checks(
        not_null=(
            *_OFFER_IDS, "offer_type", *_OFFER_PRICES, *_HOST, "gpu_memory_gb", "tflops_per_gpu", "ram_gb",
            "valid_from", "processed_at",
        ),
        not_null_warn=(
            *_HOST_WARN, "cpu_clock_speed_ghz", "disk_bandwidth_gbytes_per_sec", "total_system_tflops", "country_code",
        ),
        accepted=_OFFER,
        holds={
            NOT_NEGATIVE: (*_OFFER_UNSIGNED, "ram_gb"),
            "{c} <= total_price_usd_per_hr": ("gpu_price_usd_per_hr",),
            ABOVE_ZERO: (*_HOST_ABOVE_ZERO, "gpu_memory_gb", "tflops_per_gpu", "reliability_score"),
            NOT_FUTURE: ("valid_from",),
        },
        holds_warn={
            ABOVE_ZERO: (*_RATE_WARN, "cpu_clock_speed_ghz", "disk_bandwidth_gbytes_per_sec", "total_system_tflops"),
            UPPER_CASE: ("country_code",),
        },
        unique_keys=(("offer_id", "valid_from"),),
    ),
    "int_electricity_tariff_tiers": Checks(
        not_null=("tariff_description_en", "tariff_description_mk", "price_mkd_per_kwh", "valid_from", *_STAMPS),
        accepted={**_TYPE, **_CODE},
        holds={ABOVE_ZERO: ("price_mkd_per_kwh",), NOT_FUTURE_DAY: ("valid_from",)},
        unique_keys=(("tariff_description_en", "tariff_description_mk", "valid_from"),),
    ),
    "int_electricity_tariff_schedule": Checks(
        not_null=("day_of_week", "hour", "tariff_type", "valid_from", *_STAMPS),
        accepted=_TYPE,
        holds={WEEKDAY: ("day_of_week",), HOUR: ("hour",)},
        unique_keys=(("day_of_week", "hour", "valid_from"),),
    ),
    "int_exchange_rates": Checks(
        not_null=("from_currency", "to_currency", "value", "inverse_value", "timestamp", *_STAMPS),
        accepted=_PAIR,
        holds={ABOVE_ZERO: ("value", "inverse_value"), "{c} < value": ("inverse_value",)},
        unique_keys=(("from_currency", "to_currency", "timestamp"),),
    ),
}

WAREHOUSE = {
    "dim_electricity_tariff_tiers": Checks(
        not_null=(
            "skey", "tariff_description_en", "tariff_description_mk", "price_mkd_per_kwh", "valid_from", "is_latest",
        ),
        accepted={**_TYPE, **_CODE},
        holds={ABOVE_ZERO: ("price_mkd_per_kwh",), NOT_FUTURE_DAY: ("valid_from",)},
        row_holds=(ORDERED,),
        unique=("skey",),
        unique_keys=(("tariff_description_mk", "valid_from"),),
    ),
    "dim_electricity_tariff_schedule": Checks(
        not_null=("skey", "day_of_week", "hour", "tariff_type", "valid_from", "is_latest"),
        accepted=_TYPE,
        holds={WEEKDAY: ("day_of_week",), HOUR: ("hour",)},
        row_holds=(ORDERED,),
        unique=("skey",),
        unique_keys=(("day_of_week", "hour", "valid_from"),),
    ),
    "dim_exchange_rates": Checks(
        not_null=("skey", "from_currency", "to_currency", "value", "inverse_value", "valid_from", "is_latest"),
        accepted=_PAIR,
        holds={ABOVE_ZERO: ("value", "inverse_value"), "{c} < value": ("inverse_value",)},
        row_holds=(ORDERED,),
        unique=("skey",),
        unique_keys=(("from_currency", "to_currency", "valid_from"),),
    ),
    "fct_compute_offers": Checks(
        not_null=(
            *_OFFER_IDS, *_HOST, "gpu_memory_gb", "ram_gb", "deep_learning_score_per_usd", "gpu_price_usd_per_hr",
            "revenue_usd_per_hr",
        ),
        not_null_warn=(
            *_HOST_WARN, "country_code", "tflops_per_gpu", "disk_bandwidth_gbytes_per_sec",
            "total_system_kwh_per_hr", "total_system_tflops", "usd_to_mkd_rate", *_COSTS,
        ),
        accepted=_VERIFIED,
        holds={
            ABOVE_ZERO: (*_HOST_ABOVE_ZERO, "gpu_memory_gb", "reliability_score"),
            NOT_NEGATIVE: ("ram_gb", "deep_learning_score_per_usd", "gpu_price_usd_per_hr", "revenue_usd_per_hr"),
        },
        holds_warn={
            ABOVE_ZERO: (
                *_RATE_WARN, "disk_bandwidth_gbytes_per_sec", "total_system_kwh_per_hr", "total_system_tflops",
                "kwh_per_tflop", "usd_to_mkd_rate", *_COSTS, *_COSTS_PER_TFLOP,
            ),
            UPPER_CASE: ("country_code",),
        },
        row_holds=(ORDERED,),
        unique_keys=(("offer_id", "valid_from"),),
    ),
}

_VARIANT = ("offer_type", "gpu_architecture", "gpu_model_name")
_SHARES = (*[f"pct_profitable_{name}" for name in fixed.SCENARIOS], "pct_verified", "pct_available")

MARTS = {
    "mart_arbitrage_opportunities": Checks(
        not_null=("arbitrage_rank", *_OFFER_IDS, *_VARIANT, "number_of_gpus", "revenue_usd_per_hr", "valid_from"),
        not_null_warn=("country_code",),
        unique_keys=(("offer_type", "arbitrage_rank"),),
    ),
    "mart_best_offers_by_gpu": Checks(
        not_null=(*_VARIANT, "valid_from"),
        not_null_warn=("tflops_per_gpu",),
        unique_keys=(("offer_type", "gpu_model_name", "tflops_per_gpu", "gpu_tdp_watts", "gpu_memory_gb"),),
    ),
    "mart_profitability_trends": Checks(
        not_null=("hour_bucket", "day_of_week", "hour_of_day", *_VARIANT, "offer_count"),
        accepted_warn={"tariff_window": ("low", "high")},
        holds={WEEKDAY: ("day_of_week",), HOUR: ("hour_of_day",), ABOVE_ZERO: ("offer_count",)},
        unique_keys=(("hour_bucket", *fixed.TREND_KEYS, "tariff_window"),),
    ),
    "mart_gpu_model_summary": Checks(
        not_null=(*_VARIANT, "total_offer_observations", "last_seen_at"),
        holds={ABOVE_ZERO: ("total_offer_observations",)},
        holds_warn={PERCENT: _SHARES},
        unique_keys=(fixed.SUMMARY_KEYS,),
    ),
}

ALL = STAGING | INTERMEDIATE | WAREHOUSE | MARTS
