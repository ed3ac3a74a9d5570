"""Where tables live, and how they are read, written and published."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import literal

STAGES = ("bronze", "silver", "gold")
POLL = "poll"


@dataclass(frozen=True)
class Dataset:
    name: str
    kind: str  # "sources" or "seeds"; gold models use "models"
    enabled: bool = True


OFFERS = Dataset("compute_offers", "sources")
RATES = Dataset("exchange_rates", "sources")
TIERS = Dataset("electricity_tariff_tiers", "seeds")
SCHEDULE = Dataset("electricity_tariff_schedule", "seeds")
DATASETS = (OFFERS, RATES, TIERS, SCHEDULE)


@dataclass(frozen=True)
class Lake:
    """Tables under ``root/stage/kind/name``; a directory of Parquet files each."""

    root: str

    def path(self, stage: str, dataset: Dataset) -> str:
        if stage not in STAGES:
            raise ValueError(f"unknown stage {stage}")
        return f"{self.root.rstrip('/')}/{stage}/{dataset.kind}/{dataset.name}"

    def reject_path(self, dataset: Dataset) -> str:
        return f"{self.path('bronze', dataset)}_rejects"

    def model_path(self, model: str) -> str:
        return self.path("gold", Dataset(model, "models"))

    def marker_path(self) -> str:
        return f"{self.root.rstrip('/')}/published"


def poll_label(stamp: str = "ingested_at") -> str:
    """The partition value of a poll, as SQL."""
    return f"date_format({stamp}, 'yyyyMMddHHmmss')"


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _schema_path(path: str) -> str:
    return f"{path.rstrip('/')}.schema"


def recorded_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema noted at the last write: one small file, instead of the footers of all files."""
    try:
        noted = spark.read.schema("value string").text(_schema_path(path), wholetext=True).first()
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise
    return None if noted is None else T.StructType.fromJson(json.loads(noted.value))


def _note_schema(spark: SparkSession, path: str, written: T.StructType, replaced: bool) -> None:
    """Note the written columns after those an added-to table already has."""
    before = None if replaced else recorded_schema(spark, path)
    fields = [] if before is None else list(before.fields)
    fields += [f for f in written.fields if f.name not in {old.name for old in fields}]
    if before is None or len(fields) > len(before.fields):
        noted = spark.range(1).selectExpr(f"{literal(T.StructType(fields).json())} as value")
        noted.coalesce(1).write.mode("overwrite").text(_schema_path(path))


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None when nothing has been written there.

    With a noted schema, files that lack a later column give null for it, and no footer is read
    to plan the scan.
    """
    schema = recorded_schema(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if is_missing(error):
            return None
        raise


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
    mode: str = "overwrite", only_partitions: bool = False,
) -> None:
    """Write Parquet. ``only_partitions`` replaces just the partitions present in ``df``, not the table.

    Clustering sorts by the cluster columns: range-partitioned when the table has no partition
    columns, so that files hold narrow key ranges and their statistics let scans skip them, and files in
    name order hold the rows in order (``in_file_order``). With partition columns rows are rebalanced by these: the small shares of a
    partition meet in one file, and a partition beyond AQE's advisory size is split over several tasks.
    """
    # Noted first: a column without files reads as null, files without a noted column would hide it.
    _note_schema(df.sparkSession, path, df.schema, replaced=mode == "overwrite" and not only_partitions)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    elif cluster_by:
        df = df.repartitionByRange(*cluster_by)
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if only_partitions else "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def in_file_order(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table with their ``place`` (from 1) when its files are read one after the other by name.

    A row's place is its place in its file after the rows of the files before it, so no rows are sorted.
    """
    rows = read_table(spark, path).selectExpr("*", "_metadata.file_name as _file", "_metadata.row_index as _at")
    sizes = rows.groupBy("_file").agg(F.max("_at").alias("_last"))
    before = sizes.selectExpr("_file as _of", "sum(_last + 1) over (order by _file) - _last as _first")
    return rows.join(before, F.expr("_file = _of")).withColumn("place", F.expr("_first + _at")).drop("_file", "_of", "_at", "_first")


def write_unless_empty(df: DataFrame, path: str, **layout) -> bool:
    """Never replace a table by nothing: an empty batch leaves it as it is."""
    if df.isEmpty():
        return False
    write_table(df, path, **layout)
    return True


def register_views(spark: SparkSession, lake: Lake, datasets: Sequence[Dataset] = DATASETS, stage: str = "silver") -> None:
    """A temp view per dataset over its files."""
    for dataset in datasets:
        spark.read.parquet(lake.path(stage, dataset)).createOrReplaceTempView(dataset.name)


def publish(spark: SparkSession, lake: Lake, name: str, version: int) -> None:
    """Record that ``name`` passed its checks as of ``version``: one partition per name, replaced each time."""
    row = spark.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(name).alias("name"))
    write_table(row.coalesce(1), lake.marker_path(), partition_by=["name"], only_partitions=True)


def published_versions(spark: SparkSession, lake: Lake) -> dict[str, int]:
    """Latest published version by name; one entry per dataset or mart set."""
    markers = read_table(spark, lake.marker_path())
    if markers is None:
        return {}
    return {r.name: r.version for r in markers.groupBy("name").agg(F.max("version").alias("version")).collect()}
