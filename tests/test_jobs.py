"""From landed payloads to published marts, over several polls."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.operators.quality import QualityError
from tidemark.plans import jobs
from tidemark.sources import lake as lk
from tidemark.sources import landing
from tidemark.sources.fact_store import open_rows, read_fact
from tests.conftest import day, moment
from tests.test_landing import FULL


def offer(number, **changes):
    return FULL | {"ask_contract_id": number, "machine_id": number, "gpu_name": f"GPU {number % 3}"} | changes


def land_poll(spark, lake, hour, offers):
    at = moment(f"2026-01-{5 + hour // 24:02d}T{hour % 24:02d}:00:00")
    payload = spark.createDataFrame([(json.dumps({"offers": offers}), "on_demand", at)],
                                    "payload string, offer_type string, ingested_at timestamp")
    lk.write_table(landing.land_offers(payload)[0], lake.path("bronze", lk.OFFERS))


def land_rest(spark, lake):
    rates = [("Thu, 01 Jan 2026 00:00:01 +0000", 50.0), ("Fri, 02 Jan 2026 00:00:01 +0000", 50.0), ("Sat, 03 Jan 2026 00:00:01 +0000", 52.0)]
    payloads = [(json.dumps({"conversion_rates": {"MKD": v}, "time_last_update_utc": t}), moment("2026-01-04T00:00:00")) for t, v in rates]
    df = spark.createDataFrame(payloads, "payload string, ingested_at timestamp")
    lk.write_table(landing.land_rates(df)[0], lake.path("bronze", lk.RATES))
    lines = "".join(
        f"<tr><td> {text} </td><td>{i + 1},5</td><td>-</td><td>01.01.2026</td></tr>" for i, text in enumerate(fixed.TARIFF_CODES)
    )
    page = spark.createDataFrame([(f"<table>{lines}</table>", moment("2026-01-04T00:00:00"))], "html string, ingested_at timestamp")
    lk.write_table(landing.land_tiers(page)[0], lake.path("bronze", lk.TIERS))
    text = spark.createDataFrame([(fixed.SCHEDULE_PAGE_TEXT, moment("2026-01-04T00:00:00"))], "text string, ingested_at timestamp")
    lk.write_table(landing.land_schedule(text), lake.path("bronze", lk.SCHEDULE))


def test_whole_flow(spark, lake):
    assert not jobs.run_dataset(spark, lake, lk.OFFERS, 0).published  # nothing landed yet
    assert not jobs.marts_due(spark, lake)
    land_rest(spark, lake)
    for dataset in (lk.RATES, lk.TIERS, lk.SCHEDULE):
        assert jobs.run_dataset(spark, lake, dataset, 1).published
    rates = spark.read.parquet(lake.model_path("dim_exchange_rates")).orderBy("valid_from").collect()
    assert [(r.value, r.valid_from, r.valid_to) for r in rates] == [
        (50.0, day("2026-01-01"), day("2026-01-02")), (52.0, day("2026-01-03"), day("9999-12-31")),
    ]

    land_poll(spark, lake, 0, [offer(1), offer(2), offer(3), offer(4, rented=True)])
    run = jobs.run_dataset(spark, lake, lk.OFFERS, 2)
    assert run.published
    land_poll(spark, lake, 30, [offer(1), offer(3, discounted_dph_total=2.0)])
    assert jobs.run_dataset(spark, lake, lk.OFFERS, 3).published

    fact_path = lake.model_path("fct_compute_offers")
    fact = read_fact(spark, fact_path)
    assert fact.columns == [*fixed.FACT_ATTRIBUTES, *[c for c in fact.columns if c.endswith(("_usd_per_hr", "_usd")) and c not in fixed.FACT_ATTRIBUTES]]
    assert len(fact.columns) == 73 and fact.count() == 6
    assert sorted(r.offer_id for r in open_rows(spark, fact_path).collect()) == [1, 1, 3, 3]
    closed = {r.offer_id: r.valid_to for r in fact.filter("valid_to < timestamp'9999-12-31'").collect()}
    assert closed == {2: moment("2026-01-06T06:00:00"), 4: moment("2026-01-06T06:00:00")}
    row = fact.filter("offer_id = 1").first()
    kwh = 450 * 2 / 1000
    assert row.cost_household_1_high_usd_per_hr == pytest.approx(kwh * (1.5 + 8.5) / 52.0)
    assert row.profit_per_tflop_business_low_usd == pytest.approx((0.75 - kwh * (7.5 + 8.5) / 52.0) / row.total_system_tflops)
    assert row.gpu_memory_gb == 24 and row.country_code == "MK" and row.cpu_model_name == "AMD EPYC 7742"

    # The same poll again changes nothing.
    before = sorted(map(str, fact.collect()))
    assert jobs.run_dataset(spark, lake, lk.OFFERS, 4).published
    assert sorted(map(str, read_fact(spark, fact_path).collect())) == before

    assert jobs.marts_due(spark, lake)
    assert jobs.run_marts(spark, lake, 4).published
    assert not jobs.marts_due(spark, lake) and not jobs.run_marts(spark, lake, 5).published
    best = spark.read.parquet(lake.model_path("mart_best_offers_by_gpu"))
    assert best.count() == 2 and best.filter("gpu_model_name = 'GPU 0'").first().revenue_per_gpu_usd_per_hr == 1.0
    ranks = spark.read.parquet(lake.model_path("mart_arbitrage_opportunities")).orderBy("arbitrage_rank").collect()
    assert [r.arbitrage_rank for r in ranks] == [1, 2, 3, 4] and ranks[0].offer_id == 3
    trends = spark.read.parquet(lake.model_path("mart_profitability_trends"))
    assert {(r.hour_of_day, r.tariff_window) for r in trends.collect()} == {(0, "low"), (6, "low")}
    summary = spark.read.parquet(lake.model_path("mart_gpu_model_summary"))
    assert {r.gpu_model_name: r.total_offer_observations for r in summary.collect()} == {"GPU 0": 2, "GPU 1": 2}
    lk.register_views(spark, lake)
    assert spark.sql("select count(*) from compute_offers").first()[0] == 6  # both polls are kept


def test_landing_in_the_run_keeps_rejects(spark, lake):
    land_rest(spark, lake)
    for dataset in (lk.RATES, lk.TIERS, lk.SCHEDULE):
        jobs.run_dataset(spark, lake, dataset, 1)
    for hour, payload in enumerate([json.dumps({"offers": [offer(1), offer(2, rented="perhaps")]}), "no json", json.dumps({"offers": [offer(3)]})]):
        df = spark.createDataFrame([(payload, "bid", moment(f"2026-01-05T{hour:02d}:00:00"))], "payload string, offer_type string, ingested_at timestamp")
        assert jobs.run_dataset(spark, lake, lk.OFFERS, 2 + hour, payloads=df).published
    rejects = spark.read.parquet(lake.reject_path(lk.OFFERS))
    assert sorted((r.offer_id or "", r.failed_rules) for r in rejects.collect()) == [("", "payload:json"), ("2", "rented_flag:type")]
    assert read_fact(spark, lake.model_path("fct_compute_offers")).count() == 2
    assert lk.published_versions(spark, lake)[lk.OFFERS.name] == 4
    markers = spark.read.parquet(lake.marker_path())
    assert markers.count() == len(lk.published_versions(spark, lake))


def test_errors_stop_publishing(spark, lake):
    land_rest(spark, lake)
    bad = spark.read.parquet(lake.path("bronze", lk.RATES)).selectExpr(
        "ingested_at", "from_currency", "'XXX' as to_currency", "value", "timestamp"
    ).collect()
    lk.write_table(spark.createDataFrame(bad, "ingested_at timestamp, from_currency string, to_currency string, value double, timestamp timestamp"),
                   lake.path("bronze", lk.RATES))
    with pytest.raises(QualityError, match="to_currency"):
        jobs.run_dataset(spark, lake, lk.RATES, 1)
    assert lk.published_versions(spark, lake) == {}


def files(path):
    import pathlib

    return sorted(str(p) for p in pathlib.Path(path).rglob("*.parquet"))


def test_a_failed_load_is_dropped_and_a_mended_one_publishes(spark, lake, monkeypatch):
    land_rest(spark, lake)
    for dataset in (lk.RATES, lk.TIERS, lk.SCHEDULE):
        jobs.run_dataset(spark, lake, dataset, 1)
    land_poll(spark, lake, 0, [offer(1), offer(2)])
    assert jobs.run_dataset(spark, lake, lk.OFFERS, 2).published
    fact_path, staged = lake.model_path("fct_compute_offers"), lake.model_path("stg_compute_offers")
    before, rows = files(fact_path) + files(staged), sorted(map(str, read_fact(spark, fact_path).collect()))
    real = jobs.warehouse.fact_offers
    monkeypatch.setattr(jobs.warehouse, "fact_offers", lambda *a: real(*a).withColumn("gpu_model_name", F.lit(None).cast("string")))
    land_poll(spark, lake, 30, [offer(1)])
    with pytest.raises(QualityError, match="gpu_model_name"):
        jobs.run_dataset(spark, lake, lk.OFFERS, 3)
    monkeypatch.undo()
    assert files(fact_path) + files(staged) == before and sorted(map(str, read_fact(spark, fact_path).collect())) == rows
    assert lk.published_versions(spark, lake)[lk.OFFERS.name] == 2
    assert jobs.run_dataset(spark, lake, lk.OFFERS, 4).published  # the poll is still in silver
    assert sorted(r.offer_id for r in open_rows(spark, fact_path).collect()) == [1, 1]
    assert lk.published_versions(spark, lake)[lk.OFFERS.name] == 4


def test_a_mended_poll_replaces_the_refused_one(spark, lake):
    land_rest(spark, lake)
    for dataset in (lk.RATES, lk.TIERS, lk.SCHEDULE):
        jobs.run_dataset(spark, lake, dataset, 1)
    land_poll(spark, lake, 0, [offer(1), offer(2, num_gpus=-4)])
    with pytest.raises(QualityError):
        jobs.run_dataset(spark, lake, lk.OFFERS, 2)
    assert read_fact(spark, lake.model_path("fct_compute_offers")) is None
    land_poll(spark, lake, 0, [offer(1), offer(2)])
    assert jobs.run_dataset(spark, lake, lk.OFFERS, 3).published
    assert read_fact(spark, lake.model_path("fct_compute_offers")).count() == 2


def test_trends_follow_changed_days_only(spark, lake):
    from tidemark.plans import marts

    land_rest(spark, lake)
    for dataset in (lk.RATES, lk.TIERS, lk.SCHEDULE):
        jobs.run_dataset(spark, lake, dataset, 1)
    mart = lake.model_path("mart_profitability_trends")
    seen = {}
    for version, (hour, numbers) in enumerate([(0, (1, 2)), (30, (1, 2)), (54, (1, 3)), (55, (1, 3))], 2):
        land_poll(spark, lake, hour, [offer(n, discounted_dph_total=1.0 + n + hour) for n in numbers])
        jobs.run_dataset(spark, lake, lk.OFFERS, version)
        jobs.run_marts(spark, lake, version)
        fact = read_fact(spark, lake.model_path("fct_compute_offers"))
        schedule = spark.read.parquet(lake.model_path("dim_electricity_tariff_schedule"))
        whole = marts.trends(fact, schedule)
        assert sorted(map(str, spark.read.parquet(mart).select(whole.columns).collect())) == sorted(map(str, whole.collect()))
        now = {d: [f for f in files(mart) if f"bucket_date=2026-01-{d:02d}" in f] for d in (5, 6, 7)}
        # The second load closes nothing, the third one rows of both days before it.
        if hour == 30:
            assert now[5] == seen[5] and now[6]
        if hour == 54:
            assert now[5] != seen[5] and now[6] != seen[6] and now[7]
        if hour == 55:
            assert now[5] == seen[5] and now[6] == seen[6] and now[7] != seen[7]
        seen = now
    assert jobs.refresh_trends(spark, lake) == [] and {d: [f for f in files(mart) if f"bucket_date=2026-01-{d:02d}" in f] for d in (5, 6, 7)} == seen
    partials = jobs.SnapshotTable(spark, lake.model_path("trend_partials"), jobs.BUCKET_DAY)
    once = partials.read(partials.latest())
    # Partials of coarser groups are merged from finer ones.
    day = marts.trends_of(marts.merge_partials(once, ("offer_type",)), keys=("offer_type",)).first()
    assert day.offer_count == 8 and day.avg_revenue_usd_per_hr == pytest.approx(fact.agg(F.avg("revenue_usd_per_hr")).first()[0])


def test_disabled_dataset_and_empty_batch(spark, lake):
    from dataclasses import replace

    from tidemark.plans.refine import REFINEMENTS

    land_rest(spark, lake)
    refinement = REFINEMENTS[lk.RATES.name]
    off = replace(refinement, dataset=replace(lk.RATES, enabled=False))
    assert not off.run(spark, lake)
    assert refinement.run(spark, lake)
    path = lake.path("silver", lk.RATES)
    assert spark.read.parquet(path).schema.names == [*fixed.RATES_SILVER.names, lk.POLL]
    assert not lk.write_unless_empty(spark.read.parquet(path).filter("false"), path)
    assert spark.read.parquet(path).count() == 3


def test_paths(lake):
    assert lake.path("silver", lk.TIERS) == f"{lake.root}/silver/seeds/electricity_tariff_tiers"
    assert lk.Lake("gs://bucket/").path("bronze", lk.OFFERS) == "gs://bucket/bronze/sources/compute_offers"
    with pytest.raises(ValueError):
        lake.path("copper", lk.OFFERS)


def test_trend_loads_read_rows_that_were_written_once(spark, monkeypatch):
    from catalog import queries

    class Seen(Exception):
        pass

    def load(spark, path, batch, written=False):
        assert written and not any("events.parquet" in f for f in batch.inputFiles())
        raise Seen

    monkeypatch.setattr(queries.fact_store, "apply_polls", load)
    with pytest.raises(Seen):
        queries.QUERIES["mart_trends_incremental"](spark, "/root/testdata/sf0.001")
