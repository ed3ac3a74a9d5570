"""Helpers shared by the operators: written tables and exact texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


#: Tables that ``stored`` has written and ``discard`` has not removed, oldest first.
WRITTEN: list[str] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage in a way that survives lost executors, computes costly columns once, and gives
    later joins a measured size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Remove stored tables that nothing will read again."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        WRITTEN.remove(path)


def whole_text(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
