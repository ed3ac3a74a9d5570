"""Rows of a stream once each, by state that the watermark bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def first_sightings(stream: DataFrame, keys: Sequence[str], stamp: str, within: str) -> DataFrame:
    """``stream`` without rows whose ``keys`` came before, in this micro-batch or an earlier one.

    A key is remembered until the watermark (the latest ``stamp`` of earlier micro-batches less ``within``) has passed its first
    row by ``within``, so doubles that are less than that apart in event time are dropped and the state does not
    grow with the stream. Rows that come later than the watermark are dropped too, as nothing could be told about them; rows without a stamp
    among them. Null keys are a value like any other.
    """
    return stream.withWatermark(stamp, within).dropDuplicatesWithinWatermark(list(keys))


def write_once(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has landed to Parquet files, each row in one micro-batch whatever fails, then stop."""
    query = (
        rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
