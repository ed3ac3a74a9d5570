"""Polls as a stream: each micro-batch is merged into the stored fact, every row left out is kept aside."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.functions.text import literal, names, with_exprs
from tidemark.session import discard, scratch_path
from tidemark.sources.fact_store import DAY, apply_polls, fact_watermark, stored_fact
from tidemark.sources.lake import write_table


def poll_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """The Parquet files under a folder as a stream. A poll must not be split over micro-batches:
    land one file per poll, or leave ``files_per_batch`` unset."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def poll_merger(
    fact_path: str, reject_path: str, shape: Callable[[DataFrame], DataFrame], tie: tuple[str, ...]
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink. ``shape`` turns landed rows into fact rows with ``offer_id`` and
    ``valid_from``; of rows with equal keys the lowest by ``tie`` stays.

    What does not enter the fact goes to the reject table with its ``reason``: ``no key``, ``double`` of a row of its
    batch, or ``late``, at or below the watermark. A micro-batch that runs again after a failure adds nothing to the
    fact, and its rejects replace those of its first run, as they are a partition of their own.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        high = fact_watermark(spark, fact_path)
        # Shaped and judged once, and written: what follows reads this.
        keyless = "offer_id is null or valid_from is null"
        # Rows without a key are spread, as nothing is to be found among them.
        spread = f"case when {keyless} then pmod(xxhash64({names(tie)}), 4096) end"
        place = f"row_number() over (partition by offer_id, valid_from, {spread} order by {names(tie)})"
        late = "false" if high is None else f"valid_from <= {literal(high)}"
        reason = f"case when {keyless} then 'no key' when _place > 1 then 'double' when {late} then 'late' end"
        judged = with_exprs(with_exprs(shape(batch), {"_place": place}).withColumn("reason", F.expr(reason)), {"batch": f"{batch_id}L"}).drop("_place")
        work = scratch_path(spark, "micro-batch")
        judged.write.parquet(work)
        judged = spark.read.schema(judged.schema).parquet(work)
        try:
            reasons = {r[0] for r in judged.select("reason").distinct().collect()}
            rejects = judged.filter("reason is not null")
            if "late" in reasons:
                # On a rerun the batch's own rows are stored already; only the late rows' days are looked at.
                came = rejects.filter("reason = 'late'")
                days = came.selectExpr(f"cast(valid_from as date) as {DAY}").distinct()
                known = stored_fact(spark, fact_path).join(days, DAY, "left_semi").select("offer_id", "valid_from", *tie)
                unseen = came.join(known, ["offer_id", "valid_from", *tie], "left_anti").select(*came.columns)
                rejects = rejects.filter("reason <> 'late'").unionByName(unseen)
            if reasons - {None}:
                write_table(rejects, reject_path, partition_by=["batch"], only_partitions=True)
            if None in reasons:
                apply_polls(spark, fact_path, judged.filter("reason is null").drop("reason", "batch"), written=True)
        finally:
            discard(spark, [work])

    return merge


def run_available(source: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process what has landed, then stop."""
    query = (
        source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
