"""Offers, rates and tariffs derived from general star-schema tables, shaped like the real feeds.

Every derivation is row-local or grouped, so these frames grow with the tables they read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions import scalars as fn
from tidemark.functions.text import aliased, literal, literals, with_exprs
from tidemark.operators.cleaning import cast_to_schema, deduplicate
from tidemark.operators.incremental import highest
from tidemark.plans import intermediate, staging, warehouse
from tidemark.sources import lake as lk
from tidemark.sources.landing import weekly_schedule

SCHEDULE_FROM, SCHEDULE_CHANGE = dt.date(2024, 1, 1), dt.date(2024, 1, 16)
TIER_VERSIONS = (dt.date(2023, 12, 1), dt.date(2024, 1, 15))
# Invented prices per tariff code, one per version above.
TIER_PRICES = {
    "household_high_tariff_block_1": (5.0, 5.5),
    "household_high_tariff_block_2": (6.0, 6.5),
    "household_high_tariff_block_3": (8.0, 8.5),
    "household_high_tariff_block_4": (18.0, 19.0),
    "household_low_tariff_block": (1.5, 1.75),
    "business_high_tariff_block": (11.0, 12.0),
    "business_low_tariff_block": (5.5, 6.0),
    "distribution_fee": (3.0, 3.25),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def polled_events(events: DataFrame) -> DataFrame:
    """Events with the hour they fall in as their poll, in UTC."""
    return events.selectExpr("*", "date_trunc('hour', cast(ts as timestamp)) as ingested_at")


def unique_polls(events: DataFrame) -> DataFrame:
    """One event per (user, hour): the lowest event id."""
    slim = polled_events(events).select("user_id", "ingested_at", "event_id", "event_type", "value")
    return deduplicate(slim, ["user_id", "ingested_at"], ["event_id"])


OFFER_COLUMNS = {
    "ingested_at": "ingested_at",
    "processed_at": "ingested_at + interval 5 minutes",
    "offer_id": "user_id",
    "machine_id": "user_id % 97",
    "host_id": "user_id % 31",
    "offer_type": "case when event_type in ('view', 'click') then 'on_demand'"
                  " when event_type = 'error' then 'reserved' else 'bid' end",
    "total_price_usd_per_hr": "value / 100",
    "gpu_price_usd_per_hr": "value / 125",
    "minimum_bid_price_usd": "value / 200",
    "storage_cost_usd_per_hr": "event_id % 10 / 1000",
    "network_upload_cost_usd_per_gbit": "event_id % 7 / 1000",
    "network_download_cost_usd_per_gbit": "event_id % 5 / 1000",
    "deep_learning_score_per_usd": "p_size / (value + 1)",
    "gpu_architecture": "p_type",
    "gpu_model_name": "p_brand",
    "gpu_memory_mb": "p_partkey % 24 * 4000 + 2000",
    "gpu_tdp_watts": "case when event_id % 53 != 0 then p_size * 10 end",
    "number_of_gpus": "event_id % 4 + 1",
    "gpu_max_cuda_version_supported": "11 + event_id % 8 / 10",
    "gpu_tflops": "p_retailprice / 10",
    "gpu_bandwidth_gbytes_per_sec": "100 + p_partkey % 900",
    "cpu_architecture": "case when p_size % 2 = 0 then 'amd64' when p_size % 2 = 1 then 'arm64' end",
    "cpu_model_name": "concat(p_name, ' ', cast(p_size as string), '-Core Processor')",
    "number_of_cpu_cores": "p_size / 2",
    "cpu_clock_speed_ghz": "2 + p_size % 20 / 10",
    "ram_mb": "p_size * 1024",
    "disk_model_name": "p_name",
    "disk_space_gb": "50 + event_id % 1000",
    "disk_bandwidth_mbytes_per_sec": "500 + user_id % 3000",
    "pcie_generation": "3 + event_id % 3",
    "pcie_bandwidth_gbytes_per_sec": "5 + user_id % 40",
    "network_download_mbits_per_sec": "100 + event_id % 900",
    "network_upload_mbits_per_sec": "50 + event_id % 450",
    "reliability_score": "0.9D + event_id % 100 / 1000",
    "deep_learning_score": "p_size * 2",
    "geolocation": "concat(n_name, ', ', r_name)",
    "verification_flag": "case event_id % 5 when 0 then 'unverified' when 1 then 'deverified' else 'verified' end",
    "rentable_flag": "event_id % 7 != 0",
    "rented_flag": "event_id % 3 = 0",
}


def offers_silver(polled: DataFrame, part: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """``polled`` events as silver offers. Left joins keep every event and drop out when unread."""
    place = nation.join(region, F.expr("n_regionkey = r_regionkey"), "left")
    joined = polled.join(part, F.expr("user_id = p_partkey"), "left")
    joined = joined.join(place, F.expr("user_id % 25 = n_nationkey"), "left")
    return cast_to_schema(joined.selectExpr(*aliased(OFFER_COLUMNS)), fixed.OFFERS_SILVER)


def silver_from(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    source = table(spark, sf_dir, "events") if events is None else events
    return offers_silver(unique_polls(source), *[table(spark, sf_dir, n) for n in ("part", "nation", "region")])


def offers(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Intermediate offers, one per (offer_id, valid_from)."""
    return intermediate.offers(staging.stage(silver_from(spark, sf_dir, events), lk.OFFERS.name))


def rates_silver(events: DataFrame) -> DataFrame:
    """One rate per day: a fifth of the mean event value, whole units."""
    daily = events.groupBy(F.expr("cast(ts as date) as day")).agg(F.expr("round(avg(value) / 5) as value"))
    stamp = "cast(day as timestamp)"
    shaped = daily.selectExpr(
        f"{stamp} as ingested_at", f"{stamp} as processed_at", "'USD' as from_currency", "'MKD' as to_currency",
        "value", f"{stamp} as timestamp",
    )
    return cast_to_schema(shaped, fixed.RATES_SILVER)


def rates_dim(events: DataFrame, gap_days: int = 1) -> DataFrame:
    silver = rates_silver(events)
    return warehouse.dim_rates(intermediate.rates(staging.stage(silver, lk.RATES.name)), gap_days)


def tiers_silver(spark: SparkSession) -> DataFrame:
    descriptions = {code: text for text, code in fixed.TARIFF_CODES.items()}
    rows = [
        (descriptions[code], price, day)
        for code, prices in TIER_PRICES.items()
        for price, day in zip(prices, TIER_VERSIONS)
    ]
    frame = spark.createDataFrame(rows, "tariff_description string, price_mkd_per_kwh double, valid_from date")
    return cast_to_schema(_stamped(frame), fixed.TIERS_SILVER)


def tiers_dim(spark: SparkSession, gap_days: int = 1, stagger: int = 0) -> DataFrame:
    """``stagger`` puts the tariffs' second versions that many days apart from each other."""
    silver = tiers_silver(spark)
    if stagger:
        texts = literals(fixed.TARIFF_CODES)
        days = f"(array_position(array({texts}), tariff_description) - 1) * {stagger}"
        later = f"case when valid_from = {literal(TIER_VERSIONS[1])} then date_add(valid_from, cast({days} as int)) else valid_from end"
        silver = with_exprs(silver, {"valid_from": later})
    return warehouse.dim_tiers(intermediate.tiers(staging.stage(silver, lk.TIERS.name)), gap_days)


def schedule_dim(spark: SparkSession) -> DataFrame:
    """Two versions: from the change on, the windows of Monday to Wednesday are swapped and Sunday is as before."""
    first = with_exprs(weekly_schedule(spark), {"valid_from": literal(SCHEDULE_FROM)})
    swapped = "case when day_of_week > 3 then tariff_type when tariff_type = 'low' then 'high' else 'low' end"
    second = with_exprs(first.filter("day_of_week < 7"), {"tariff_type": swapped, "valid_from": literal(SCHEDULE_CHANGE)})
    silver = cast_to_schema(_stamped(first.unionByName(second)), fixed.SCHEDULE_SILVER)
    return warehouse.dim_schedule(intermediate.schedule(staging.stage(silver, lk.SCHEDULE.name)))


def shared_offers(fact: DataFrame) -> DataFrame:
    """The fact with few variants, observed every six hours, so that many rows share a trend group."""
    coarse = {c: f"cast(null as {kind})" for c, kind in fact.dtypes if c in fixed.TREND_KEYS}
    coarse |= {
        "offer_type": "offer_type", "gpu_model_name": "concat('M', offer_id % 2)", "gpu_architecture": "'A'",
        "valid_from": "date_trunc('day', valid_from) + make_interval(0, 0, 0, 0, cast(floor(hour(valid_from) / 6) * 6 as int), 0, 0)",
    }
    return with_exprs(fact, coarse)


def _stamped(df: DataFrame) -> DataFrame:
    stamp = "cast(valid_from as timestamp)"
    return with_exprs(df, {"ingested_at": stamp, "processed_at": stamp})


def latest_poll(events: DataFrame) -> Column:
    """The last hour with events, read from one event column without building the offers."""
    return F.date_trunc("hour", highest(events, "ts").cast("timestamp"))


def latest_ids(events: DataFrame) -> DataFrame:
    """Ids of the last poll. The hour bounds the raw column, so that the scan can skip by its statistics."""
    newest = highest(events, "ts")
    recent = events.filter(F.col("ts") >= F.date_trunc("hour", newest).cast("timestamp_ntz"))
    return recent.selectExpr("user_id as offer_id")


def fact(spark: SparkSession, sf_dir: str, tiers: DataFrame | None = None, tiers_per_span: bool = False) -> DataFrame:
    """The offers fact after one full load: priced, with rows absent from the last poll closed."""
    events = table(spark, sf_dir, "events")
    source = offers(spark, sf_dir, events)
    priced = warehouse.fact_offers(source, rates_dim(events), tiers_dim(spark) if tiers is None else tiers, tiers_per_span=tiers_per_span)
    return warehouse.close_single_load(priced, latest_poll(events), latest_ids(events))


# ---------------------------------------------------------------- order-shaped tariffs

_DESCRIPTIONS = [*fixed.TARIFF_CODES, "Непозната тарифа", ""]


def order_tariffs(orders: DataFrame) -> DataFrame:
    """Orders as tariff notices: one description per order out of ten, per customer and day."""
    return orders.selectExpr(
        "o_orderkey", "o_custkey",
        f"element_at(array({literals(_DESCRIPTIONS)}), cast(o_orderkey % {len(_DESCRIPTIONS)} + 1 as int))"
        " as tariff_description",
        "floor(o_totalprice / 10) / 100 as price_mkd_per_kwh",
        "cast(o_orderdate as date) as valid_from",
    )


def order_schedule(orders: DataFrame) -> DataFrame:
    """Orders as schedule rows per customer: the order's weekday and a span of up to six hours."""
    return orders.selectExpr(
        "o_orderkey", "o_custkey", f"{fn.iso_weekday('o_orderdate')} as day_of_week",
        "o_orderkey % 22 as start_hour", "o_orderkey % 22 + o_custkey % 7 as end_hour",
        "case when o_orderstatus = 'F' then 'low' else 'high' end as tariff_type",
        "cast(o_orderdate as date) as valid_from",
    )
