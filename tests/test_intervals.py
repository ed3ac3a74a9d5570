import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tidemark.operators import intervals as iv
from tests.conftest import day, rows

FOREVER = dt.date(9999, 12, 31)


def versions(spark, *pairs):
    return spark.createDataFrame([(k, day(d)) for k, d in pairs], "k string, d date")


def spans(df):
    return sorted((r.k, r.valid_from, r.valid_to, r.is_latest) for r in df.collect())


def test_scd2(spark):
    df = versions(spark, ("one", "2024-01-01"), ("two", "2024-01-01"), ("two", "2024-01-02"), ("two", "2024-02-01"))
    got = spans(iv.scd2(df, ["k"], "d", ["k", "d"]))
    assert got == [
        ("one", day("2024-01-01"), FOREVER, True),
        ("two", day("2024-01-01"), day("2024-01-01"), False),  # consecutive days: an empty interval
        ("two", day("2024-01-02"), day("2024-01-31"), False),
        ("two", day("2024-02-01"), FOREVER, True),
    ]
    gapless = spans(iv.scd2(df, ["k"], "d", ["k", "d"], gap_days=0))
    assert [s[2] for s in gapless] == [FOREVER, day("2024-01-02"), day("2024-02-01"), FOREVER]


def test_scd2_same_day_twice_ends_before_it_starts(spark):
    got = spans(iv.scd2(versions(spark, ("a", "2024-01-05"), ("a", "2024-01-05")), ["k"], "d", ["k", "d"]))
    assert sorted(s[2] for s in got) == [day("2024-01-04"), FOREVER]


days = st.integers(0, 120).map(lambda n: dt.date(2024, 1, 1) + dt.timedelta(n))
histories = st.lists(st.tuples(st.sampled_from(["a", "b", None]), days, st.sampled_from([1.0, 2.0, None])), max_size=25)


@settings(max_examples=6, deadline=None)
@given(histories)
def test_chunked_history_equals_plain(spark, items):
    df = spark.createDataFrame([(k, d, v, i) for i, (k, d, v) in enumerate(items)], "k string, d date, v double, i int")
    plain = iv.changes_only(df, ["k"], "d", "v", tie=["i"])
    chunked = iv.changes_only(df, ["k"], "d", "v", tie=["i"], chunk="trunc(d, 'month')")
    assert rows(plain) == rows(chunked)
    assert rows(iv.scd2(df, ["k"], "d", ["k"], tie=["i"])) == rows(
        iv.scd2(df, ["k"], "d", ["k"], tie=["i"], chunk="trunc(d, 'week')")
    )


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), days), min_size=1, max_size=20, unique=True))
def test_intervals_of_a_key_are_ordered_and_disjoint(spark, items):
    df = spark.createDataFrame(items, "k string, d date")
    by_key = {}
    for k, start, end, _ in spans(iv.scd2(df, ["k"], "d", ["k", "d"], gap_days=0)):
        assert start < end
        assert by_key.get(k, start) <= start
        by_key[k] = end


def test_changes_only(spark):
    df = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 6.0), ("a", 4, 5.0), ("b", 1, None), ("b", 2, None), ("b", 3, 1.0)],
        "k string, t int, v double",
    )
    kept = iv.changes_only(df, ["k"], "t", "v")
    assert sorted((r.k, r.t) for r in kept.collect()) == [("a", 1), ("a", 3), ("a", 4), ("b", 1), ("b", 2), ("b", 3)]


def test_weekly_schedule_fills_168_hours(spark):
    from tidemark.sources.landing import weekly_schedule

    schedule = weekly_schedule(spark)
    assert schedule.count() == 31
    hours = iv.calendar_expand(schedule)
    assert hours.count() == 168 == hours.select("day_of_week", "hour").distinct().count()
    assert {r.tariff_type: r["count"] for r in hours.groupBy("tariff_type").count().collect()} == {"high": 78, "low": 90}
    calendar = iv.hourly_calendar(spark)
    joined = iv.range_join(
        calendar, schedule.withColumnRenamed("day_of_week", "d"), "hour", "start_hour", "end_hour", "day_of_week = d", "inner"
    )
    assert rows(joined.select("day_of_week", "hour", "tariff_type")) == rows(hours.select("day_of_week", "hour", "tariff_type"))


def test_calendar_ignores_empty_and_outside(spark):
    df = spark.createDataFrame([(1, 5, 5, "x"), (1, 6, 4, "x"), (1, 22, 30, "y"), (8, 0, 3, "z"), (2, None, 3, "n")],
                               "day_of_week long, start_hour long, end_hour long, kind string")
    assert rows(iv.calendar_expand(df).select("day_of_week", "hour")) == [(1, 22), (1, 23)]


def facts(spark):
    return spark.range(0, 420).selectExpr("date_add(date'2023-11-01', cast(id as int)) as at", "id as n").unionByName(
        spark.sql("select cast(null as date) as at, -1L as n union all select date'9999-12-31', -2L")
    )


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(days, st.one_of(st.just(FOREVER), days), st.integers(0, 3)), max_size=12))
def test_interval_join_equals_range_join(spark, items):
    dim = spark.createDataFrame(items, "s date, e date, v int")
    want = rows(iv.range_join(facts(spark), dim, "at", "s", "e").select("at", "n", "s", "e", "v"))
    for options in ({}, {"salts": 3}):
        assert rows(iv.interval_join(facts(spark), dim, "at", "s", "e", **options).select("at", "n", "s", "e", "v")) == want


def test_interval_join_edges(spark):
    dim = spark.createDataFrame([(day("2024-01-10"), day("2024-01-20"), "closed"), (day("2024-01-20"), FOREVER, "open")], "s date, e date, v string")
    at = spark.sql("select explode(array(date'2024-01-09', date'2024-01-10', date'2024-01-19', date'2024-01-20', date'2500-01-01')) as at")
    got = {r.at.isoformat(): r.v for r in iv.interval_join(at, dim, "at", "s", "e").collect()}
    assert got == {"2024-01-09": None, "2024-01-10": "closed", "2024-01-19": "closed", "2024-01-20": "open", "2500-01-01": "open"}


def test_interval_join_is_a_hash_join(spark):
    dim = spark.createDataFrame([(day("2024-01-10"), FOREVER, 1)], "s date, e date, v int")
    empty = dim.selectExpr("s", "s as e", "v")
    for of in (dim, empty):
        joined = iv.interval_join(facts(spark), of, "at", "s", "e")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert joined.count() == 422


def test_copies_of_one_fact_row_are_spread_over_salts(spark):
    hot = spark.range(0, 8000, 1, 8).selectExpr("date'2024-01-15' as at", "1 as n")
    dim = spark.createDataFrame([(day("2024-01-10"), FOREVER, 1)], "s date, e date, v int")
    assert iv.interval_join(hot, dim, "at", "s", "e", salts=4).filter("v = 1").count() == 8000


def test_asof_join_equals_range_join(spark):
    import datetime as dt
    import random

    order, base = random.Random(3), dt.datetime(2024, 1, 25)
    at = lambda minutes: base + dt.timedelta(minutes=minutes)
    dim, n = [], 0
    for k in (1, 2, 3):
        t = 0
        for _ in range(40):
            t += order.randint(1, 900)
            end = t + order.randint(0, 400)
            dim.append((k, n, at(t), at(end)))
            t, n = end, n + 1
    facts = [(order.choice([1, 2, 3, 4, None]), i, at(order.randint(-500, 30_000)) if i % 37 else None) for i in range(600)]
    # Facts on both borders of an interval, and copies.
    facts += [(k, 1000 + i, t) for i, (k, _, lo, hi) in enumerate(dim) for t in (lo, hi)] + facts[:50]
    dims = spark.createDataFrame(dim, "k int, state int, lo timestamp, hi timestamp")
    rows_ = spark.createDataFrame(facts, "k int, f int, at timestamp")
    want = rows_.alias("f").join(dims.alias("d"), F.expr("f.k = d.k and at >= lo and at < hi"), "left").select("f.k", "f", "at", "state", "lo", "hi")
    for salts in (1, 4):
        got = iv.asof_join(rows_, dims, "at", "lo", "hi", keys=["k"], salts=salts)
        assert got.columns == want.columns and rows(got) == rows(want)
        inner = iv.asof_join(rows_, dims, "at", "lo", "hi", keys=["k"], how="inner", salts=salts)
        assert rows(inner) == rows(want.filter("state is not null"))
    one = dims.filter("k = 1").drop("k")
    got = iv.asof_join(rows_, one, "at", "lo", "hi", chunk="trunc({t}, 'week')", salts=3)
    want = rows_.join(one, F.expr("at >= lo and at < hi"), "left")
    assert rows(got) == rows(want)
    plan = iv.asof_join(rows_.drop("f"), dims, "at", "lo", "hi", keys=["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan  # no row per day covered
    for empty in (dims.filter("false"), dims.withColumn("hi", F.col("lo"))):
        assert iv.asof_join(rows_, empty, "at", "lo", "hi", keys=["k"]).filter("state is null").count() == len(facts)
    with pytest.raises(ValueError):
        iv.asof_join(rows_, dims, "at", "lo", "hi", how="full")


def test_hot_asof_events_of_one_month_meet_in_many_tasks(spark, tmp_path):
    from catalog.queries import QUERIES

    spark.range(20_000).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 120) as ts", "id % 50 as user_id",
        "if(id % 5 = 0, 'purchase', 'view') as event_type", "1.0D as value", "'{}' as props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = QUERIES["interval_join_asof_hot"](spark, str(tmp_path))
        by_task = joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count("state_id").alias("found"))
        sizes = [r.n for r in by_task.collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 20_000 and max(sizes) < 1000
