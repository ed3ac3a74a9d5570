"""The corpus pipeline: quality, exact and near duplicates, mixing and packing, each stage on what the last one kept.

Stages are functions of ``(spark, docs, sf_dir)`` whose results are lazy. ``run`` writes each stage's rows as Parquet to the shared
folder and reads them back for the next one. A stage removes the tables that the stage before it made on the way, in the same
thread and for the same folder, unless its own input still reads them, as when stages are chained without writing. The first stage
removes nothing, as the tables that it finds are another run's.

Defined cases: null and empty texts are judged, and stay in the first stages by the classifier's verdict; as texts without words they are
linked with nothing, exact copies of one another all the same, and the mix takes none of them; null and repeated ids are decided by row (id and text); rows equal in
both count once from the exact stage on; extra columns, whatever their names, are kept up to the mix; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, mixing, near_dedup, packing, quality_model
from tidemark.llm.base import WRITTEN, discard, stored

#: Tables of the stage before, by session, thread and input folder.
_SPENT: dict[tuple[str, int, str], list[str]] = {}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_model.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per distinct text."""
    return exact_dedup.keep_distinct(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group of near duplicates."""
    return near_dedup.keep_distinct(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed in sequences."""
    return packing.pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _tidy(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        owner = (spark.sparkContext.applicationId, threading.get_ident(), sf_dir)
        spent, read = [] if stage is quality else _SPENT.get(owner, []), docs.inputFiles()
        needed = [path for path in spent if any(path.rsplit("/", 1)[-1] in file for file in read)]
        discard(spark, [path for path in spent if not needed])
        before = len(WRITTEN)
        rows = stage(spark, docs, sf_dir)
        _SPENT[owner] = (spent if needed else []) + WRITTEN[before:]
        return rows

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("quality", _tidy(quality)), ("exact_dedup", _tidy(exact)), ("near_dedup", _tidy(near)), ("mixing", _tidy(mixed)), ("packing", _tidy(packed)),
]

#: Trained weights and seeded hashes have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(spark, last)
        last = WRITTEN[-1:]
    return docs
