import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators import incremental as inc
from tidemark.sources.fact_store import DAY, apply_polls, read_fact, stored_fact
from tests.conftest import moment, rows

FOREVER = dt.datetime(9999, 12, 31)
SHAPE = "offer_id long, valid_from timestamp, valid_to timestamp, price double"


def polled(spark, items, shape=SHAPE):
    """(id, hour) pairs as open fact rows."""
    base = dt.datetime(2024, 1, 30)
    return spark.createDataFrame(
        [(i, base + dt.timedelta(hours=h), FOREVER, float(h)) for i, h in items], shape
    )


def outcome(df):
    return sorted((r.offer_id if r.offer_id is not None else -1, r.valid_from, r.valid_to) for r in df.collect())


def brute_force(items):
    """Polls loaded one at a time; after each, open rows of absent ids are closed."""
    base, table = dt.datetime(2024, 1, 30), {}
    for hour in sorted({h for _, h in items}):
        now = base + dt.timedelta(hours=hour)
        present = {i for i, h in items if h == hour}
        for i in present:
            table[(i, now)] = FOREVER
        for (i, start), end in table.items():
            if end == FOREVER and start < now and i is not None and i not in present:
                table[(i, start)] = now
    return sorted((i if i is not None else -1, start, end) for (i, start), end in table.items())


def test_incremental_filter(spark):
    source = spark.range(0, 10).selectExpr("id as ts")
    assert inc.incremental_filter(source, None, "ts").count() == 10
    assert inc.incremental_filter(source, source.filter("false"), "ts").count() == 10
    target = source.filter("ts <= 6")
    assert rows(inc.incremental_filter(source, target, "ts")) == [(7,), (8,), (9,)]
    assert inc.late_rows(source, target, "ts").count() == 7
    assert inc.late_rows(source, None, "ts").count() == 0


def test_merge_upsert(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "k int, v string")
    batch = spark.createDataFrame([(2, "b"), (2, "a"), (3, "new"), (None, "new")], "k int, v string")
    merged = inc.merge_upsert(target, batch, ["k"], order_by=["v"])
    assert rows(merged) == rows(spark.createDataFrame(
        [(1, "old"), (2, "a"), (3, "new"), (None, "old"), (None, "new")], "k int, v string"))
    keyed = merged.dropna()
    assert rows(inc.merge_upsert(keyed, keyed.filter("k > 1"), ["k"], ["v"])) == rows(keyed)
    with pytest.raises(ValueError):
        inc.merge_upsert(target, batch, ["k"], order_by=[])


def test_append_evolving(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2, True)], "k int, flag boolean")
    out = inc.append_evolving(a, b)
    assert out.columns == ["k", "v", "flag"]
    assert rows(out) == [(1, "x", None), (2, None, True)]


def test_close_absent(spark):
    fact = polled(spark, [(1, 0), (2, 0), (None, 0), (2, 1)])
    fact = fact.unionByName(spark.createDataFrame([(9, moment("2024-01-29"), moment("2024-01-29T05:00:00"), 0.0)], SHAPE))
    latest = moment("2024-01-30T01:00:00")
    ids = spark.createDataFrame([(2,), (None,)], "offer_id long")
    closed = inc.close_absent(fact, latest, ids)
    ends = {(r.offer_id, r.valid_from.isoformat()): r.valid_to for r in closed.collect()}
    assert ends == {
        (1, "2024-01-30T00:00:00"): latest, (2, "2024-01-30T00:00:00"): FOREVER, (None, "2024-01-30T00:00:00"): FOREVER,
        (2, "2024-01-30T01:00:00"): FOREVER, (9, "2024-01-29T00:00:00"): moment("2024-01-29T05:00:00"),
    }
    assert outcome(inc.close_absent(closed, latest, ids)) == outcome(closed)
    assert inc.close_absent(fact, None, ids) is fact


# Hours reach over a month border, so that carrying between months is exercised.
feeds = st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 4)), st.integers(0, 60)), min_size=1, max_size=40, unique=True)


@settings(max_examples=6, deadline=None)
@given(feeds)
def test_replay_equals_polls_one_by_one(spark, items):
    assert outcome(inc.close_by_replay(polled(spark, items))) == brute_force(items)


def test_one_full_load_is_not_a_replay(spark):
    items = [(1, 0), (2, 0), (2, 1), (1, 2)]
    fact = polled(spark, items)
    once = inc.close_absent(fact, moment("2024-01-30T02:00:00"), fact.filter("price = 2").select("offer_id"))
    assert outcome(once) != outcome(inc.close_by_replay(fact))


def test_stored_fact_follows_polls_one_by_one(spark, tmp_path):
    items = [(1, 0), (2, 0), (1, 1), (3, 1), (3, 5), (2, 5), (2, 30), (4, 30), (2, 54), (1, 54)]
    path = str(tmp_path / "fact")
    for hour in sorted({h for _, h in items}):
        assert apply_polls(spark, path, polled(spark, [(i, h) for i, h in items if h == hour])) > 0
    assert outcome(read_fact(spark, path)) == brute_force(items)
    days = {r[0] for r in stored_fact(spark, path).select(DAY).distinct().collect()}
    assert days == {dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1)}


def test_stored_fact_takes_several_polls_at_once_and_repeats_nothing(spark, tmp_path):
    items = [(1, 0), (2, 0), (1, 1), (3, 1), (3, 5), (2, 5), (2, 30), (4, 30), (None, 30), (2, 54), (1, 54)]
    path = str(tmp_path / "fact")
    early = polled(spark, [x for x in items if x[1] < 5])
    late = polled(spark, [x for x in items if x[1] >= 5])
    apply_polls(spark, path, early)
    apply_polls(spark, path, late)
    assert outcome(read_fact(spark, path)) == brute_force(items)
    before = rows(read_fact(spark, path))
    assert apply_polls(spark, path, late) == 0
    assert apply_polls(spark, path, early) == 0
    assert rows(read_fact(spark, path)) == before


def test_stored_fact_gains_a_column(spark, tmp_path):
    path = str(tmp_path / "fact")
    apply_polls(spark, path, polled(spark, [(1, 0), (2, 0)]))
    apply_polls(spark, path, polled(spark, [(1, 30)]).selectExpr("*", "'x' as extra"))
    got = {(r.offer_id, r.extra) for r in read_fact(spark, path).collect()}
    assert got == {(1, None), (2, None), (1, "x")}


@settings(max_examples=2, deadline=None)
@given(feeds, st.integers(0, 60))
def test_stored_fact_split_anywhere(spark, tmp_path_factory, items, cut):
    path = str(tmp_path_factory.mktemp("split") / "fact")
    for part in ([x for x in items if x[1] < cut], [x for x in items if x[1] >= cut]):
        if part:
            apply_polls(spark, path, polled(spark, part))
    assert outcome(read_fact(spark, path)) == brute_force(items)


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    import pathlib

    from tidemark.sources.fact_store import upsert_partitions
    from tidemark.sources.lake import read_table

    path, shape, keys = str(tmp_path / "table"), "k int, v string, d string", ["k", "d"]
    first = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (1, "a", "y")], shape)
    assert upsert_partitions(spark, path, first, keys, "d", ["v"]) == 2
    untouched = sorted(p.name for p in pathlib.Path(path, "d=y").iterdir())
    batch = spark.createDataFrame([(2, "c", "x"), (2, "b", "x"), (3, "b", "x")], shape)
    for _ in range(2):
        assert upsert_partitions(spark, path, batch, keys, "d", ["v"]) == 1
        got = rows(read_table(spark, path).select("k", "v", "d"))
        assert got == [(1, "a", "x"), (1, "a", "y"), (2, "b", "x"), (3, "b", "x")]
    assert sorted(p.name for p in pathlib.Path(path, "d=y").iterdir()) == untouched
    assert upsert_partitions(spark, path, batch.filter("false"), keys, "d", ["v"]) == 0


def test_upsert_keeps_the_null_partition(spark, tmp_path):
    from tidemark.sources.fact_store import upsert_partitions
    from tidemark.sources.lake import read_table

    path, shape = str(tmp_path / "table"), "k int, v string, d string"
    upsert_partitions(spark, path, spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "a", "x")], shape), ["k", "d"], "d", ["v"])
    upsert_partitions(spark, path, spark.createDataFrame([(9, "b", None)], shape), ["k", "d"], "d", ["v"])
    assert [r[0] for r in rows(read_table(spark, path).select("k"))] == [1, 2, 3, 9]


def test_doubled_rows_end_alike(spark):
    doubled = polled(spark, [(1, 0), (1, 1), (2, 0)])
    doubled = doubled.unionByName(doubled.filter("offer_id = 1 and price = 0"))
    ends = [(r.offer_id, r.price, r.valid_to) for r in inc.close_by_replay(doubled).collect()]
    assert sorted(ends) == [(1, 0.0, FOREVER), (1, 0.0, FOREVER), (1, 1.0, FOREVER), (2, 0.0, moment("2024-01-30T01:00:00"))]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("where", ["stage", "publish"])
def test_a_load_may_stop_anywhere(spark, tmp_path, monkeypatch, where):
    from tidemark.sources import snapshots

    items = [(1, 0), (2, 0), (5, 0), (1, 30), (3, 30), (3, 54), (5, 54)]
    first, second = ([x for x in items if (x[1] < 30) == early] for early in (True, False))
    path = str(tmp_path / "fact")
    apply_polls(spark, path, polled(spark, first))
    stage = snapshots.SnapshotTable.stage

    def stop(self, *args):
        if where == "stage":
            stage(self, *args)
        raise Stopped

    monkeypatch.setattr(snapshots.SnapshotTable, where, stop)
    with pytest.raises(Stopped):
        apply_polls(spark, path, polled(spark, second))
    monkeypatch.undo()
    assert outcome(read_fact(spark, path)) == brute_force(first)  # readers see the last published load
    apply_polls(spark, path, polled(spark, second))
    assert outcome(read_fact(spark, path)) == brute_force(items)


def test_a_refused_load_leaves_the_version_readers_see(spark, tmp_path):
    from tidemark.sources.fact_store import fact_table

    def audit(rewritten):
        if rewritten.groupBy("offer_id", "valid_from").count().filter("count > 1").count():
            raise Stopped

    items = [(1, 0), (2, 0), (1, 30), (3, 30)]
    path = str(tmp_path / "fact")
    apply_polls(spark, path, polled(spark, items[:2]), audit=audit)
    files = sorted(p.name for p in (tmp_path / "fact" / "data").iterdir())
    with pytest.raises(Stopped):
        apply_polls(spark, path, polled(spark, [*items[2:], items[3]]), audit=audit)
    assert outcome(read_fact(spark, path)) == brute_force(items[:2])
    assert sorted(p.name for p in (tmp_path / "fact" / "data").iterdir()) == files
    assert apply_polls(spark, path, polled(spark, items[2:]), audit=audit) == 2
    assert outcome(read_fact(spark, path)) == brute_force(items) and fact_table(spark, path).numbers() == [1, 2]


def test_watermark_is_noted(spark, tmp_path):
    from tidemark.sources import fact_store

    path = str(tmp_path / "fact")
    apply_polls(spark, path, polled(spark, [(1, 0), (1, 30), (2, 54)]))
    assert fact_store.fact_watermark(spark, path) == moment("2024-02-01T06:00:00")
