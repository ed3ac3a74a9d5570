"""Building a plan runs nothing, and no plan compares every row with every other."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.operators import incremental
from tidemark.plans import marts, standin, warehouse

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("events", "part", "nation", "region")


@pytest.fixture
def fact(spark, monkeypatch):
    """The fact's builder over tables that are already opened; opening one reads its footer in a job."""
    opened = {t: standin.table(spark, SF_DIR, t) for t in TABLES}
    monkeypatch.setattr(standin, "table", lambda s, d, t: opened[t])
    return lambda: standin.fact(spark, SF_DIR)


def started(spark, build):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    df = build()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    return df, n


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_building_starts_no_job(spark, fact):
    built, n = started(spark, fact)
    assert n == 0
    schedule = standin.schedule_dim(spark)
    for build in (
        lambda: marts.best_offers(built), lambda: marts.model_summary(built), lambda: marts.trends(built, schedule),
        lambda: incremental.close_by_replay(built.select("offer_id", "valid_from", "valid_to")),
        lambda: incremental.merge_upsert(built, built, ["offer_id", "valid_from"], ["valid_from"]),
    ):
        df, n = started(spark, build)
        assert n == 0 and "NestedLoop" not in plan_of(df) and "Cartesian" not in plan_of(df)


def test_no_nested_loop_with_dimensions_of_empty_intervals(spark, fact):
    events = standin.table(spark, SF_DIR, "events")
    rates = standin.rates_dim(events).withColumn("valid_to", F.col("valid_from"))
    df = warehouse.fact_offers(standin.offers(spark, SF_DIR, events), rates, standin.tiers_dim(spark))
    assert "NestedLoop" not in plan_of(df) and df.filter("usd_to_mkd_rate is not null").isEmpty()


def test_the_last_poll_is_looked_up_by_the_raw_column(spark, fact):
    plan = plan_of(standin.latest_ids(standin.table(spark, SF_DIR, "events")))
    assert re.search(r"Filter \(isnotnull\(ts#\d+\) AND \(ts#\d+ >= cast\(date_trunc", plan)
