"""The stored offers fact: day partitions under versions, of which a load rewrites only those it changes.

A load is written beside the table and audited as a candidate version; only when it passes does it become the version that readers
see (``snapshots``). So a load may stop or fail anywhere: the version before it stays, and the same or a mended batch
is loaded again from there. The watermark is a note of the version.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed
from tidemark.functions.text import literal, name, with_exprs
from tidemark.operators.cleaning import deduplicate
from tidemark.operators.incremental import append_evolving, close_by_replay, merge_upsert
from tidemark.session import discard, scratch_path
from tidemark.sources.lake import read_table, write_table
from tidemark.sources.snapshots import SnapshotTable, Version, folder

DAY = "valid_from_date"
FOREVER = literal(fixed.OPEN_TIMESTAMP)
CLUSTER = ("gpu_model_name", "offer_type")
WATERMARK = "watermark"

Audit = Callable[[DataFrame], Any]


def fact_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, DAY)


def _watermark(version: Version | None) -> dt.datetime | None:
    # Noted with its offset, as Spark hands instants to Python in local time.
    return None if version is None else dt.datetime.fromisoformat(version.notes[WATERMARK]).astimezone().replace(tzinfo=None)


def fact_watermark(spark: SparkSession, path: str) -> dt.datetime | None:
    """The latest poll that the current version holds."""
    return _watermark(fact_table(spark, path).latest())


def stored_fact(spark: SparkSession, path: str) -> DataFrame | None:
    """The current version of the fact, with its day column; None before the first one."""
    table = fact_table(spark, path)
    version = table.latest()
    return None if version is None else table.read(version)


def read_fact(spark: SparkSession, path: str) -> DataFrame | None:
    fact = stored_fact(spark, path)
    return None if fact is None else fact.drop(DAY)


def open_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows still open; file statistics on ``valid_to`` let the scan skip closed files."""
    fact = stored_fact(spark, path)
    return None if fact is None else fact.filter(f"valid_to = {FOREVER}")


def apply_polls(
    spark: SparkSession, path: str, batch: DataFrame, key: str = "offer_id", audit: Audit | None = None, written: bool = False
) -> int:
    """Add a batch of one or more whole polls, and close what each of them lacks.

    Same outcome as loading the polls one by one and calling ``close_absent`` after each, but
    in one pass: the batch is replayed together with one anchor row per id that is open at the
    last poll of the current version. Rows at or below the watermark are left out, so a repeated batch changes
    nothing. ``audit`` sees the rewritten days of the candidate, as other days are files of versions that passed; if it raises,
    the candidate is dropped and the current version stays.
    ``written`` tells that the batch is read from files, so that no copy of it need be made. Returns the number of
    day partitions written.
    """
    table = fact_table(spark, path)
    base = table.latest()
    done = _watermark(base)
    fresh = batch.filter("valid_from is not null") if done is None else batch.filter(f"valid_from > {literal(done)}")
    beside: list[str] = []

    def kept_beside(df: DataFrame) -> DataFrame:
        beside.append(scratch_path(spark, "fact-load"))
        df.write.parquet(beside[-1])
        return spark.read.schema(df.schema).parquet(beside[-1])

    try:
        fresh = fresh if written else kept_beside(fresh)
        found = fresh.selectExpr("max(valid_from) as high", "collect_set(cast(valid_from as date)) as days").first()
        if found.high is None:
            return 0
        days = set(found.days)
        rows, replaced = _replayed(spark, table, base, done, fresh, days, key, kept_beside)
        candidate = table.stage(rows, base, replaced, {WATERMARK: found.high.astimezone(dt.timezone.utc).isoformat()}, [c for c in CLUSTER if c in fresh.columns])
        try:
            if audit is not None:
                audit(table.read(candidate, replaced))
            table.publish(candidate)
        except BaseException:
            table.drop(candidate)
            raise
        return len(replaced)
    finally:
        discard(spark, beside)


def _replayed(
    spark: SparkSession, table: SnapshotTable, base: Version | None, done: dt.datetime | None, fresh: DataFrame, days: set[dt.date], key: str,
    kept_beside: Callable[[DataFrame], DataFrame],
) -> tuple[DataFrame, set[str]]:
    """The rows of all partitions that a load changes, and their folders.

    Only days with newly closed rows and days of the batch are rewritten. Their number is
    bounded by the calendar, which is all the driver sees.
    """
    if base is None:
        return with_exprs(close_by_replay(fresh, key), {DAY: "cast(valid_from as date)"}), {folder(DAY, d) for d in days}
    k, last = name(key), literal(done)
    still_open = table.read(base).filter(f"valid_to = {FOREVER}")
    anchors = still_open.select(key).distinct().selectExpr(k, f"{last} as valid_from")
    runs = append_evolving(fresh, anchors)
    # The last stored poll is part of the sequence even if nothing of it is still open.
    previous = spark.range(1).selectExpr(f"{last} as valid_from")
    # Read three times below, so written once.
    ends = kept_beside(close_by_replay(runs, key, polls=runs.select("valid_from").unionByName(previous)))

    closing = ends.filter(f"valid_from = {last} and valid_to < {FOREVER}").selectExpr(f"{k} as _gone", "valid_to as _closed_at")
    hit = still_open.join(closing, F.expr(f"{k} = _gone")).select(DAY).distinct()
    replaced = {folder(DAY, d) for d in days | {r[0] for r in hit.collect()}}
    touched = table.read(base, replaced).join(closing, F.expr(f"{k} = _gone"), "left")
    closed_at = f"case when valid_to = {FOREVER} and _gone is not null then _closed_at else valid_to end"
    kept = with_exprs(touched, {"valid_to": closed_at}).drop("_gone", "_closed_at")
    added = with_exprs(ends.filter(f"valid_from > {last}"), {DAY: "cast(valid_from as date)"})
    return append_evolving(kept, added), replaced


def upsert_partitions(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition_by: str, order_by: Sequence[str]
) -> int:
    """``merge_upsert`` into a stored table, rewriting only the partitions the batch falls in.

    ``partition_by`` must be among ``keys``, so that a row and its replacement share a partition; a null
    partition is one like any other. Returns the number of partitions written. Repeating a batch leaves the
    table as it is, unless it has null keys, which match nothing.

    The touched values are few beside the rows and known to the driver, so they reach the scan as literals: other partitions are not
    listed for reading, whatever size the join is planned for.
    """
    if partition_by not in keys:
        raise ValueError(f"{partition_by} must be one of the merge keys")
    values = [r[0] for r in batch.select(partition_by).distinct().collect()]
    if not values:
        return 0
    stored = read_table(spark, path)
    if stored is None:
        merged = deduplicate(batch, keys, order_by)
    else:
        touched = F.col(partition_by).isin([v for v in values if v is not None])
        if None in values:
            touched = touched | F.col(partition_by).isNull()
        rewritten = stored.filter(touched)
        merged = merge_upsert(rewritten, batch, keys, order_by)
    write_table(merged, path, partition_by=[partition_by], only_partitions=True)
    return len(values)
