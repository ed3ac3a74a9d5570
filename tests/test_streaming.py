import datetime as dt

from tidemark.sources.fact_store import read_fact
from tidemark.streaming import polls
from tests.test_incremental import FOREVER, brute_force, outcome


def test_stream_equals_polls_one_by_one_and_keeps_late_rows(spark, tmp_path):
    items = [(1, 0), (2, 0), (1, 1), (3, 1), (3, 5), (2, 5), (2, 30), (4, 30), (2, 54), (1, 54)]
    base, landed = dt.datetime(2024, 1, 30), tmp_path / "landed"
    shape = "offer_id long, valid_from timestamp, valid_to timestamp, seq long"

    def land(batch):
        data = [(i, base + dt.timedelta(hours=h), FOREVER, n) for n, (i, h) in enumerate(batch)]
        spark.createDataFrame(data, shape).coalesce(1).write.mode("append").parquet(str(landed))

    fact, late, checkpoint = (str(tmp_path / n) for n in ("fact", "late", "checkpoint"))
    sink = polls.poll_merger(fact, late, lambda df: df, tie=("seq",))

    def drain():
        source = polls.poll_stream(spark, str(landed), spark.read.parquet(str(landed)).schema, files_per_batch=1)
        polls.run_available(source, sink, checkpoint)

    for hour in (0, 1, 5):
        land([x for x in items if x[1] == hour])
        drain()
    land([x for x in items if x[1] > 5] + [(2, 54)])  # three polls in one file, one row doubled
    drain()
    assert outcome(read_fact(spark, fact).select("offer_id", "valid_from", "valid_to")) == brute_force(items)

    land([(9, 3), (1, 0)])  # a row that comes too late, and one already stored
    drain()
    assert outcome(read_fact(spark, fact)) == brute_force(items)
    kept = {(r.offer_id, r.valid_from, r.reason) for r in spark.read.parquet(late).collect()}
    assert kept == {(9, base + dt.timedelta(hours=3), "late"), (2, base + dt.timedelta(hours=54), "double"), (1, base, "late")}

    nothing = spark.createDataFrame([(None, base, FOREVER, 0), (7, None, FOREVER, 1)], shape)
    sink(nothing, 50)
    assert spark.read.parquet(late).filter("reason = 'no key'").count() == 2

    before = outcome(read_fact(spark, fact))
    sink(spark.read.parquet(str(landed)), 99)  # a batch that runs again
    assert outcome(read_fact(spark, fact)) == before


def test_doubles_over_micro_batches_are_dropped_and_state_is_evicted(spark, tmp_path):
    from tidemark.streaming import dedup

    base, shape = dt.datetime(2024, 1, 30), "id long, at timestamp"
    landed, once, checkpoint = (str(tmp_path / n) for n in ("landed", "once", "checkpoint"))

    def drain(items):
        rows = [(i, base + dt.timedelta(hours=h)) for i, h in items]
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(landed)
        stream = polls.poll_stream(spark, landed, spark.read.parquet(landed).schema)
        return dedup.write_once(dedup.first_sightings(stream, ["id"], "at", "10 hours"), once, checkpoint)

    kept = []
    for items in ([(1, 0), (2, 1), (2, 1)], [(1, 0), (3, 5), (None, 5), (None, 6)], [(3, 5), (4, 40)], [(1, 41), (5, 2)], [(6, 90)]):
        query = drain(items)
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = sorted((r.id or 0, int((r.at - base).total_seconds()) // 3600) for r in spark.read.schema(shape).parquet(once).collect())
    # 1 comes again after its state is gone; 5 is later than the watermark.
    assert got == [(0, 5), (1, 0), (1, 41), (2, 1), (3, 5), (4, 40), (6, 90)]
    assert max(kept) <= 5 and kept[-1] <= 2
