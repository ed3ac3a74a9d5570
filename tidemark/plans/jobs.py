"""End-to-end runs: one dataset from landed payloads to checked gold tables, and the marts over them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import with_exprs
from tidemark.operators.cleaning import deduplicate
from tidemark.operators.quality import Checks, gate, run_checks, singular_check
from tidemark.plans import checks as declared
from tidemark.plans import intermediate, marts, staging, warehouse
from tidemark.plans.refine import REFINEMENTS
from tidemark.sources import lake as lk
from tidemark.sources import landing
from tidemark.session import discard, scratch_path
from tidemark.sources.fact_store import DAY, apply_polls, fact_table, fact_watermark, read_fact
from tidemark.sources.snapshots import Candidate, SnapshotTable, changed, folder

MARTS = "marts"
#: Number of the load that added a staging row, and the partition of staging tables.
INCREMENT = "increment"
BUCKET_DAY = "bucket_date"
# Mart -> how its files are laid out.
MART_LAYOUT = {
    "mart_arbitrage_opportunities": {"cluster_by": ("offer_type", "gpu_model_name")},
    "mart_best_offers_by_gpu": {"cluster_by": ("offer_type", "gpu_architecture", "gpu_model_name")},
    "mart_gpu_model_summary": {"cluster_by": ("gpu_model_name", "offer_type")},
}
TREND_LAYOUT = {"partition_by": (BUCKET_DAY,), "cluster_by": ("gpu_model_name", "offer_type")}


@dataclass(frozen=True)
class Run:
    """What one run did: warnings of its checks, and whether it published."""

    warnings: list[str]
    published: bool


def check_tables(tables: dict[str, DataFrame], now: str = "current_timestamp()") -> list[str]:
    """Run the declared checks of each table; raise on errors, return the warnings."""
    warnings: list[str] = []
    for table, df in tables.items():
        warnings += gate(run_checks(df, table, declared.ALL.get(table, Checks()), now))
        if table == "stg_electricity_tariff_schedule":
            warnings += gate(singular_check(df.filter("start_hour >= end_hour"), table, "hour range"))
    return warnings


LANDERS: dict[str, Callable[[DataFrame], tuple[DataFrame, DataFrame | None]]] = {
    lk.OFFERS.name: landing.land_offers,
    lk.RATES.name: landing.land_rates,
    lk.TIERS.name: landing.land_tiers,
    lk.SCHEDULE.name: lambda pages: (landing.land_schedule(pages), None),
}


def land(lake: lk.Lake, dataset: lk.Dataset, payloads: DataFrame) -> bool:
    """Landed payloads to bronze; what is left out goes to the dataset's reject table, one partition per poll."""
    valid, rejects = LANDERS[dataset.name](payloads)
    if rejects is not None:
        kept = with_exprs(rejects, {lk.POLL: lk.poll_label()})
        lk.write_unless_empty(kept, lake.reject_path(dataset), partition_by=[lk.POLL], only_partitions=True)
    return lk.write_unless_empty(valid, lake.path("bronze", dataset))


def staging_table(spark: SparkSession, lake: lk.Lake, dataset: lk.Dataset) -> SnapshotTable:
    return SnapshotTable(spark, lake.model_path(f"stg_{dataset.name}"), INCREMENT)


def _staged(table: SnapshotTable, silver: DataFrame, dataset: lk.Dataset) -> tuple[Candidate | None, DataFrame, DataFrame]:
    """What staging would hold with the rows that are new, as a candidate if there are any; all its rows, and the new ones.

    Rows above the watermark match no stored key, so merging them is appending. The watermark is part of every key, so
    what checks find among the new rows is what they would find in all of them.
    """
    base = table.latest()
    target = None if base is None else table.read(base).drop(INCREMENT)
    batch = staging.stage_increment(silver, dataset.name, target)
    keys = staging.LAYOUT[dataset.name][2]
    batch = deduplicate(batch, keys, [c for c in batch.columns if c not in keys])
    if batch.isEmpty() and target is not None:
        return None, target, target.filter("false")
    number = 1 if base is None else base.number + 1
    candidate = table.stage(batch.withColumn(INCREMENT, F.lit(number)), base, (), {})
    new = table.read(candidate, {folder(INCREMENT, number)}).drop(INCREMENT)
    return candidate, table.read(candidate).drop(INCREMENT), new


# Each checks what a load would make of its gold tables, and stores them if they pass. They return the warnings.


def _checked_dim(spark: SparkSession, lake: lk.Lake, tables: dict[str, DataFrame], model: str, built: DataFrame, **layout) -> list[str]:
    beside = scratch_path(spark, model)
    built.write.parquet(beside)
    candidate = spark.read.schema(built.schema).parquet(beside)
    try:
        warnings = check_tables({**tables, model: candidate})
        lk.write_table(candidate, lake.model_path(model), **layout)
    finally:
        discard(spark, [beside])
    return warnings


def _gold_rates(spark: SparkSession, lake: lk.Lake, staged: DataFrame, new: DataFrame) -> list[str]:
    middle = intermediate.rates(staged)
    dim = warehouse.dim_rates(middle, chunk="trunc(timestamp, 'month')")
    tables = {"stg_exchange_rates": new, "int_exchange_rates": middle}
    return _checked_dim(spark, lake, tables, "dim_exchange_rates", dim, cluster_by=("from_currency", "to_currency"))


def _gold_tiers(spark: SparkSession, lake: lk.Lake, staged: DataFrame, new: DataFrame) -> list[str]:
    middle = intermediate.tiers(staged)
    tables = {"stg_electricity_tariff_tiers": new, "int_electricity_tariff_tiers": middle}
    return _checked_dim(spark, lake, tables, "dim_electricity_tariff_tiers", warehouse.dim_tiers(middle))


def _gold_schedule(spark: SparkSession, lake: lk.Lake, staged: DataFrame, new: DataFrame) -> list[str]:
    middle = intermediate.schedule(staged)
    tables = {"stg_electricity_tariff_schedule": new, "int_electricity_tariff_schedule": middle}
    return _checked_dim(spark, lake, tables, "dim_electricity_tariff_schedule", warehouse.dim_schedule(middle), cluster_by=("day_of_week", "hour", "valid_from"))


def _gold_offers(spark: SparkSession, lake: lk.Lake, staged: DataFrame, new: DataFrame) -> list[str]:
    """Price only the polls the fact has not seen, merge them and close absent offers in a candidate, and publish it if it passes.

    Checked are the days that the load rewrites; other days are files of versions that passed. The fact's only key holds
    ``valid_from``, so equal keys share a day.
    """
    middle = intermediate.offers(staged)
    path = lake.model_path("fct_compute_offers")
    before = fact_watermark(spark, path)
    unseen = middle if before is None else middle.filter(F.col("valid_from") > F.lit(before))
    rates = spark.read.parquet(lake.model_path("dim_exchange_rates"))
    tiers = spark.read.parquet(lake.model_path("dim_electricity_tariff_tiers"))
    warnings = check_tables({"stg_compute_offers": new, "int_compute_offers": intermediate.offers(new)})

    def audit(rewritten: DataFrame) -> None:
        warnings.extend(check_tables({"fct_compute_offers": rewritten.drop(DAY)}))

    apply_polls(spark, path, warehouse.fact_offers(unseen, rates, tiers), audit=audit)
    return warnings


GOLD: dict[str, Callable[[SparkSession, lk.Lake, DataFrame, DataFrame], list[str]]] = {
    lk.RATES.name: _gold_rates,
    lk.TIERS.name: _gold_tiers,
    lk.SCHEDULE.name: _gold_schedule,
    lk.OFFERS.name: _gold_offers,
}


def run_dataset(
    spark: SparkSession, lake: lk.Lake, dataset: lk.Dataset, version: int, clock: str = "current_timestamp()",
    payloads: DataFrame | None = None,
) -> Run:
    """Land ``payloads`` if given, refine, and write, audit and publish staging and gold.

    When a check fails, readers keep the tables they had: candidates of staging and of the fact are dropped. The poll stays in silver,
    so landing a mended payload of the same stamp, or mending the code, lets the next run publish.
    """
    if payloads is not None and dataset.enabled:
        land(lake, dataset, payloads)
    if not REFINEMENTS[dataset.name].run(spark, lake, clock):
        return Run([], False)
    lk.register_views(spark, lake, [dataset])
    table = staging_table(spark, lake, dataset)
    candidate, staged, new = _staged(table, spark.read.parquet(lake.path("silver", dataset)), dataset)
    try:
        warnings = GOLD[dataset.name](spark, lake, staged, new)
        # Last, as a run that stops before this stages the same rows again, which gold then knows.
        if candidate is not None:
            table.publish(candidate)
    except BaseException:
        if candidate is not None:
            table.drop(candidate)
        raise
    lk.publish(spark, lake, dataset.name, version)
    return Run(warnings, True)


def marts_due(spark: SparkSession, lake: lk.Lake) -> bool:
    """Whether any dataset was published after the marts were."""
    seen = lk.published_versions(spark, lake)
    return any(version > seen.get(MARTS, -1) for name, version in seen.items() if name != MARTS)


def refresh_trends(spark: SparkSession, lake: lk.Lake) -> list[str]:
    """Bring the trends up to the current version of the fact, by the days that changed since they were last built.

    Sums, counts, minima and maxima per group are stored by day; the mart is a projection of them. Both are replaced for days whose
    files differ between the fact's version noted then and the current one. A changed schedule, or a version that is
    no longer kept, rebuilds all days.
    """
    source = fact_table(spark, lake.model_path("fct_compute_offers"))
    partials = SnapshotTable(spark, lake.model_path("trend_partials"), BUCKET_DAY)
    schedule = spark.read.parquet(lake.model_path("dim_electricity_tariff_schedule"))
    looks = str(schedule.agg(F.expr("struct(count(*), bit_xor(xxhash64(*)))")).first()[0])
    now, base = source.latest(), partials.latest()
    known = base is not None and base.notes["schedule"] == looks and base.notes["fact"] in source.numbers()
    days = None if not known else changed(source.version(base.notes["fact"]), now)
    if days is not None and not days:
        return []
    buckets = None if days is None else {folder(BUCKET_DAY, d.partition("=")[2]) for d in days}
    rows = with_exprs(marts.trend_partials(source.read(now, days), schedule), {BUCKET_DAY: "cast(hour_bucket as date)"})
    candidate = partials.stage(rows, base, buckets, {"fact": now.number, "schedule": looks}, ("gpu_model_name", "offer_type"))
    try:
        built = marts.trends_of(partials.read(candidate, buckets), (BUCKET_DAY,))
        warnings = check_tables({"mart_profitability_trends": built})
        lk.write_table(built, lake.model_path("mart_profitability_trends"), **TREND_LAYOUT, only_partitions=days is not None)
        partials.publish(candidate)
    except BaseException:
        partials.drop(candidate)
        raise
    return warnings


def run_marts(spark: SparkSession, lake: lk.Lake, version: int) -> Run:
    """Rebuild the marts of open rows, refresh the trends, check, and publish if checks pass."""
    if not marts_due(spark, lake):
        return Run([], False)
    fact = read_fact(spark, lake.model_path("fct_compute_offers"))
    built = {
        "mart_arbitrage_opportunities": marts.opportunities(fact),
        "mart_best_offers_by_gpu": marts.best_offers(fact),
        "mart_gpu_model_summary": marts.model_summary(fact),
    }
    stored = {}
    for model, df in built.items():
        lk.write_table(df, lake.model_path(model), **MART_LAYOUT[model])
        stored[model] = spark.read.parquet(lake.model_path(model))
    warnings = check_tables(stored) + refresh_trends(spark, lake)
    lk.publish(spark, lake, MARTS, version)
    return Run(warnings, True)
