import pytest

from tidemark.sources.snapshots import Conflict, SnapshotTable, changed, folder

SHAPE = "k int, v string, d date"


def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "table"), "d")


def frame(spark, rows, shape=SHAPE):
    return spark.createDataFrame(rows, shape.replace("d date", "s string")).selectExpr("k", "v", *(["e"] if "e " in shape else []), "cast(s as date) as d")


def content(df):
    return sorted(map(str, df.collect()))


def test_versions_stay_as_they_were(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.latest() is None
    one = t.publish(t.stage(frame(spark, [(1, "a", "2024-01-01"), (2, "a", "2024-01-02"), (3, "a", None)]), None, None, {"n": 1}))
    touched = {folder("d", "2024-01-02"), folder("d", None)}
    candidate = t.stage(frame(spark, [(2, "b", "2024-01-02"), (4, "b", None)]), one, touched, {"n": 2})
    assert t.latest() == one and content(t.read(candidate, touched)) == content(frame(spark, [(2, "b", "2024-01-02"), (4, "b", None)]))
    two = t.publish(candidate)
    assert t.latest() == two and two.notes == {"n": 2} and changed(one, two) == touched and changed(None, one) == set(one.loads)
    assert content(t.read(one)) == content(frame(spark, [(1, "a", "2024-01-01"), (2, "a", "2024-01-02"), (3, "a", None)]))
    assert content(t.read(two)) == content(frame(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (4, "b", None)]))
    # A replaced partition without rows goes.
    three = t.publish(t.stage(frame(spark, []), two, touched, {}))
    assert content(t.read(three)) == content(frame(spark, [(1, "a", "2024-01-01")]))
    assert t.read(t.publish(t.stage(frame(spark, []), three, None, {}))).count() == 0


def test_later_columns_are_null_in_older_files(spark, tmp_path):
    t = table(spark, tmp_path)
    one = t.publish(t.stage(frame(spark, [(1, "a", "2024-01-01")]), None, None, {}))
    more = frame(spark, [(2, "b", "2024-01-02")]).selectExpr("k", "v", "'x' as e", "d")
    two = t.publish(t.stage(more, one, (), {}))
    assert {(r.k, r.e) for r in t.read(two).collect()} == {(1, None), (2, "x")}


def test_a_second_writer_is_refused(spark, tmp_path):
    t = table(spark, tmp_path)
    one = t.publish(t.stage(frame(spark, [(1, "a", "2024-01-01")]), None, None, {}))
    mine, other = (t.stage(frame(spark, [(k, "b", "2024-01-02")]), one, (), {}) for k in (2, 3))
    two = t.publish(mine)
    with pytest.raises(Conflict):
        t.publish(other)
    t.drop(other)
    assert t.latest() == two and content(t.read(two)) == content(frame(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-02")]))
    with pytest.raises(ValueError):
        t.stage(frame(spark, [(9, "x", "2024-01-01")]), two, (), {})


def test_retire_keeps_what_the_last_versions_list(spark, tmp_path):
    t = table(spark, tmp_path)
    base = None
    for i in range(4):
        rows = frame(spark, [(i, "a", "2024-01-01")] + ([(9, "z", "2024-01-09")] if i == 0 else []))
        base = t.publish(t.stage(rows, base, {folder("d", "2024-01-01")} if base else None, {}))
    t.stage(frame(spark, [(7, "lost", "2024-01-03")]), base, (), {})  # nobody came back for this one
    t.retire(keep=2)
    assert t.numbers() == [3, 4] and content(t.read(base)) == content(frame(spark, [(3, "a", "2024-01-01"), (9, "z", "2024-01-09")]))
    assert content(t.read(t.version(3))) == content(frame(spark, [(2, "a", "2024-01-01"), (9, "z", "2024-01-09")]))
    assert len(list((tmp_path / "table" / "data").glob("load_id=*"))) == 3


def test_small_shares_of_a_partition_meet_in_one_file(spark, tmp_path):
    t = table(spark, tmp_path)
    rows = spark.range(0, 4000, numPartitions=8).selectExpr("cast(id as int) as k", "'v' as v", "date_add(date'2024-01-01', cast(id % 4 as int)) as d")
    t.publish(t.stage(rows, None, None, {}))
    assert len(list((tmp_path / "table").rglob("*.parquet"))) == 4


def test_files_in_name_order_hold_the_order(spark, tmp_path):
    from tidemark.sources.lake import in_file_order, write_table

    path = str(tmp_path / "sorted")
    rows = spark.range(0, 5000, numPartitions=7).selectExpr("pmod(xxhash64(id), 1000) as a", "id as b")
    write_table(rows, path, cluster_by=("a", "b"))
    got = [(r.a, r.b) for r in in_file_order(spark, path).orderBy("place").collect()]
    assert got == sorted((r.a, r.b) for r in rows.collect())
    assert [r.place for r in in_file_order(spark, path).orderBy("place").collect()] == list(range(1, 5001))


def test_upsert_reads_touched_partitions_only(spark, tmp_path, monkeypatch):
    from tidemark.sources import fact_store

    path = str(tmp_path / "table")
    rows = spark.range(0, 100).selectExpr("id as k", "concat('p', id % 10) as p", "'old' as v").unionByName(spark.createDataFrame([(900, None, "old")], "k long, p string, v string"))
    fact_store.upsert_partitions(spark, path, rows, ["k", "p"], "p", ["v"])
    plans = []
    real = fact_store.merge_upsert

    def merge(target, *args):
        plans.append(target._jdf.queryExecution().executedPlan().toString())
        return real(target, *args)

    monkeypatch.setattr(fact_store, "merge_upsert", merge)
    assert fact_store.upsert_partitions(spark, path, spark.createDataFrame([(3, "p3", "new")], "k long, p string, v string"), ["k", "p"], "p", ["v"]) == 1
    assert fact_store.upsert_partitions(spark, path, spark.createDataFrame([(901, None, "new")], "k long, p string, v string"), ["k", "p"], "p", ["v"]) == 1
    assert "PartitionFilters: [isnotnull(p" in plans[0] and "p3" in plans[0] and "isnull(p" in plans[1]
    got = {(r.k, r.p): r.v for r in fact_store.read_table(spark, path).collect()}
    assert len(got) == 102 and got[(3, "p3")] == "new" and got[(13, "p3")] == "old" and got[(900, None)] == "old" and got[(901, None)] == "new"
