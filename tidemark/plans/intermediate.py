"""Staging to intermediate: derived columns. Lazy frames, never written."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark import fixed
from tidemark.functions import scalars as fn
from tidemark.functions.text import literal, with_exprs
from tidemark.operators.intervals import calendar_expand

# Staging columns that a derived column takes the place of.
_REPLACED = ("gpu_memory_mb", "gpu_tflops", "ram_mb", "disk_bandwidth_mbytes_per_sec", "geolocation", "ingested_at")


def offers(staged: DataFrame) -> DataFrame:
    """Units converted, per-GPU TFLOPS, country, and an open validity starting at the poll."""
    derived = {
        "gpu_memory_gb": fn.to_whole(fn.mb_to_gb(fn.nearest_size("gpu_memory_mb"))),
        "gpu_max_cuda_version_supported": "round(gpu_max_cuda_version_supported, 1)",
        "tflops_per_gpu": "gpu_tflops / number_of_gpus",
        "total_system_tflops": "gpu_tflops",
        "ram_gb": fn.mb_to_gb("ram_mb"),
        "disk_bandwidth_gbytes_per_sec": fn.mb_to_gb("disk_bandwidth_mbytes_per_sec"),
        "country_code": fn.country_code("geolocation"),
        "valid_from": "ingested_at",
        "valid_to": literal(fixed.OPEN_TIMESTAMP),
    }
    return with_exprs(staged, derived).drop(*_REPLACED)


def tiers(staged: DataFrame) -> DataFrame:
    rest = [c for c in staged.columns if c != "tariff_description"]
    return staged.selectExpr(
        f"{fn.tariff_type('tariff_description')} as tariff_type",
        f"{fn.tariff_code('tariff_description')} as tariff_description_en",
        "tariff_description as tariff_description_mk",
        *rest,
    )


def rates(staged: DataFrame) -> DataFrame:
    return with_exprs(staged, {"inverse_value": fn.inverse("value")})


def schedule(staged: DataFrame) -> DataFrame:
    return calendar_expand(staged)
