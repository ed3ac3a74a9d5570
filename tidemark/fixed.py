"""Fixed values that results depend on: names, codes, word lists and schemas."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

OPEN_DATE = dt.date(9999, 12, 31)
OPEN_TIMESTAMP = dt.datetime(9999, 12, 31, tzinfo=dt.timezone.utc)

# Accepted codes.
OFFER_TYPES = ("on_demand", "bid", "reserved")
VERIFICATION_FLAGS = ("verified", "unverified", "deverified")
TARIFF_TYPES = ("high", "low")
FROM_CURRENCY = "USD"
TO_CURRENCY = "MKD"

# Standard GPU memory sizes in MB, ascending.
GPU_MEMORY_SIZES_MB = (
    2048, 3072, 4096, 5120, 6144, 8192, 10240, 11264, 12288, 16384,
    20480, 24576, 32768, 40960, 49152, 65536, 81920, 98304, 143360, 184320,
)

# Last word of a tariff description -> tariff type.
HIGH_TARIFF_WORDS = ("ВТ1", "ВТ2", "ВТ3", "ВТ4", "ВТ")
LOW_TARIFF_WORDS = ("НТ",)

# Published tariff description -> code.
TARIFF_CODES = {
    "Домаќинства ДВОТАРИФНО мерење (висока тарифа) ВТ1": "household_high_tariff_block_1",
    "Домаќинства ДВОТАРИФНО мерење (висока тарифа) ВТ2": "household_high_tariff_block_2",
    "Домаќинства ДВОТАРИФНО мерење (висока тарифа) ВТ3": "household_high_tariff_block_3",
    "Домаќинства ДВОТАРИФНО мерење (висока тарифа) ВТ4": "household_high_tariff_block_4",
    "Домаќинства ДВОТАРИФНО мерење (ниска тарифа) НТ": "household_low_tariff_block",
    "мали потрошувачи (висока тарифа) ВТ": "business_high_tariff_block",
    "мали потрошувачи (ниска тарифа) НТ": "business_low_tariff_block",
    "Надоместок за пренос и дистрибуција": "distribution_fee",
}
UNKNOWN_TARIFF = "unknown_tariff"
DISTRIBUTION_FEE = "distribution_fee"

# Cost scenario -> tariff code that prices it.
SCENARIOS = {
    "household_1_high": "household_high_tariff_block_1",
    "household_2_high": "household_high_tariff_block_2",
    "household_3_high": "household_high_tariff_block_3",
    "household_4_high": "household_high_tariff_block_4",
    "household_low": "household_low_tariff_block",
    "business_high": "business_high_tariff_block",
    "business_low": "business_low_tariff_block",
}

# Weekly schedule, (weekdays, start hour, end hour, tariff type); Monday is 1.
WEEKLY_SCHEDULE = (
    (range(1, 7), 0, 7, "low"),
    (range(1, 7), 7, 13, "high"),
    (range(1, 7), 13, 15, "low"),
    (range(1, 7), 15, 22, "high"),
    (range(1, 7), 22, 24, "low"),
    (range(7, 8), 0, 24, "low"),
)
SCHEDULE_VALID_FROM = "01.01.2026"

# Text the schedule page must show for the weekly schedule to hold.
SCHEDULE_PAGE_TEXT = (
    "Ниската тарифа е од 13:00 до 15:00 часот и од 22:00 до 07:00 часот секој ден, како и од "
    "22:00 часот (сабота) до 07:00 часот (понеделник) преку викенд. Според одлуките на "
    "Регулаторната комисија за енергетика и водни услуги на Република Северна Македонија, "
    "цените ќе се применуваат почнувајќи од 01.01.2026."
)

_S, _I, _L, _F, _D, _B = (
    T.StringType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.BooleanType(),
)

# Offer column -> (payload key, silver type, required when landing).
OFFER_FIELDS = {
    "offer_id": ("ask_contract_id", _I, True),
    "machine_id": ("machine_id", _I, True),
    "host_id": ("host_id", _I, True),
    "offer_type": (None, _S, True),
    "total_price_usd_per_hr": ("discounted_dph_total", _F, True),
    "gpu_price_usd_per_hr": ("dph_base", _F, True),
    "minimum_bid_price_usd": ("min_bid", _F, False),
    "storage_cost_usd_per_hr": ("storage_total_cost", _F, False),
    "network_upload_cost_usd_per_gbit": ("inet_up_cost", _F, False),
    "network_download_cost_usd_per_gbit": ("inet_down_cost", _F, False),
    "deep_learning_score_per_usd": ("dlperf_per_dphtotal", _F, True),
    "gpu_architecture": ("gpu_arch", _S, True),
    "gpu_model_name": ("gpu_name", _S, True),
    "gpu_memory_mb": ("gpu_ram", _F, True),
    "gpu_tdp_watts": ("gpu_max_power", _F, False),
    "number_of_gpus": ("num_gpus", _I, True),
    "gpu_max_cuda_version_supported": ("cuda_max_good", _F, False),
    "gpu_tflops": ("total_flops", _F, False),
    "gpu_bandwidth_gbytes_per_sec": ("gpu_mem_bw", _F, False),
    "cpu_architecture": ("cpu_arch", _S, False),
    "cpu_model_name": ("cpu_name", _S, False),
    "number_of_cpu_cores": ("cpu_cores_effective", _F, False),
    "cpu_clock_speed_ghz": ("cpu_ghz", _F, False),
    "ram_mb": ("cpu_ram", _F, True),
    "disk_model_name": ("disk_name", _S, False),
    "disk_space_gb": ("disk_space", _F, True),
    "disk_bandwidth_mbytes_per_sec": ("disk_bw", _F, False),
    "pcie_generation": ("pci_gen", _F, False),
    "pcie_bandwidth_gbytes_per_sec": ("pcie_bw", _F, False),
    "network_download_mbits_per_sec": ("inet_down", _F, True),
    "network_upload_mbits_per_sec": ("inet_up", _F, True),
    "reliability_score": ("reliability2", _F, False),
    "deep_learning_score": ("dlperf", _F, False),
    "geolocation": ("geolocation", _S, False),
    "verification_flag": ("verification", _S, True),
    "rentable_flag": ("rentable", _B, True),
    "rented_flag": ("rented", _B, True),
}
# Used only when the payload lacks the key; an explicit null stays null.
OFFER_KEY_DEFAULTS = {"min_bid": "0", "num_gpus": "1"}

_STAMPS = [T.StructField("ingested_at", T.TimestampType()), T.StructField("processed_at", T.TimestampType())]


def _silver(**columns: T.DataType) -> T.StructType:
    return T.StructType(_STAMPS + [T.StructField(name, kind) for name, kind in columns.items()])


OFFERS_SILVER = _silver(**{name: kind for name, (_, kind, _) in OFFER_FIELDS.items()})
RATES_SILVER = _silver(from_currency=_S, to_currency=_S, value=_F, timestamp=T.TimestampType())
TIERS_SILVER = _silver(tariff_description=_S, price_mkd_per_kwh=_F, valid_from=T.DateType())
SCHEDULE_SILVER = _silver(
    tariff_type=_S, day_of_week=_I, start_hour=_I, end_hour=_I, valid_from=T.DateType()
)

# Offer columns whose float reading is stored as a whole number from staging on.
WHOLE_NUMBER_MEASURES = ("gpu_memory_mb", "number_of_cpu_cores", "ram_mb")

# Fixed value: the trailing core count of processor names.
CORE_SUFFIX = r"\s+\d+-Cores? Processor$"

# Column order of the offers fact up to the generated scenario columns.
FACT_ATTRIBUTES = (
    "offer_id", "machine_id", "host_id", "valid_from", "valid_to", "processed_at",
    "offer_type", "exchange_rate_skey",
    "country_code", "verification_flag", "rentable_flag", "rented_flag", "reliability_score",
    "gpu_architecture", "gpu_model_name", "number_of_gpus", "tflops_per_gpu", "gpu_tdp_watts",
    "gpu_memory_gb", "gpu_max_cuda_version_supported", "gpu_bandwidth_gbytes_per_sec",
    "cpu_architecture", "cpu_model_name", "number_of_cpu_cores", "cpu_clock_speed_ghz",
    "ram_gb", "disk_model_name", "disk_space_gb", "disk_bandwidth_gbytes_per_sec",
    "pcie_generation", "pcie_bandwidth_gbytes_per_sec",
    "network_download_mbits_per_sec", "network_upload_mbits_per_sec",
    "network_download_cost_usd_per_gbit", "network_upload_cost_usd_per_gbit",
    "deep_learning_score", "deep_learning_score_per_usd",
    "gpu_price_usd_per_hr", "minimum_bid_price_usd", "storage_cost_usd_per_hr", "revenue_usd_per_hr",
    "total_system_kwh_per_hr", "total_system_tflops", "kwh_per_tflop",
    "usd_to_mkd_rate",
)

# Column order of the opportunities mart before its scenario columns.
OPPORTUNITY_ATTRIBUTES = (
    "arbitrage_rank", "offer_type", "offer_id", "machine_id", "host_id",
    "country_code", "reliability_score",
    "gpu_architecture", "gpu_model_name", "number_of_gpus", "tflops_per_gpu", "total_system_tflops",
    "gpu_memory_gb", "gpu_tdp_watts", "gpu_bandwidth_gbytes_per_sec", "gpu_max_cuda_version_supported",
    "cpu_architecture", "cpu_model_name", "number_of_cpu_cores", "cpu_clock_speed_ghz",
    "ram_gb", "disk_space_gb", "disk_bandwidth_gbytes_per_sec",
    "pcie_generation", "pcie_bandwidth_gbytes_per_sec",
    "network_download_mbits_per_sec", "network_upload_mbits_per_sec",
    "network_download_cost_usd_per_gbit", "network_upload_cost_usd_per_gbit",
    "kwh_per_tflop", "deep_learning_score", "deep_learning_score_per_usd",
    "gpu_price_usd_per_hr", "minimum_bid_price_usd", "storage_cost_usd_per_hr", "revenue_usd_per_hr",
    "usd_to_mkd_rate",
)

# Column order of the best-offer mart before its scenario columns.
BEST_OFFER_ATTRIBUTES = (
    "offer_type", "gpu_architecture", "gpu_model_name", "gpu_memory_gb", "gpu_tdp_watts",
    "tflops_per_gpu", "kwh_per_tflop", "verification_flag", "rentable_flag", "rented_flag",
    "reliability_score", "country_code",
)

# Group keys of the summary and trend marts (the trend keys follow its time keys).
SUMMARY_KEYS = ("offer_type", "gpu_architecture", "gpu_model_name", "tflops_per_gpu", "gpu_memory_gb")
TREND_KEYS = (
    "offer_type", "gpu_architecture", "gpu_model_name", "gpu_memory_gb", "gpu_tdp_watts",
    "gpu_bandwidth_gbytes_per_sec", "gpu_max_cuda_version_supported", "number_of_gpus",
)
