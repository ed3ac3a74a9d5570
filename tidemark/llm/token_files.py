"""Token ids as Parquet lists that can be read selectively.

Documents are dealt into files by ranges of ``doc_id`` (of text hashes within one id) and sorted in them, so that files in name order hold ids in
ascending order. Ids are a dictionary-encoded list column (a file has few distinct ids beside its length), counts and
positions are delta-encoded; row groups and pages are kept small, and Parquet's page indexes let a reader of a few
documents, or of the metadata alone, skip the rest. Each row has its position in its file, so a document's
place in the whole corpus is its file's offset plus that.

Defined cases: null text has the end id alone; null ids come first; rows that share an id are ordered by a hash of
their text; an empty table gives no rows; other columns of ``docs`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.session import scratch_path

END_ID = 2
FILE_BYTES = 32 << 20
#: Files whose counts are summed together.
RUN = 4096
SCHEMA = "part int, doc_id bigint, position bigint, n_tokens bigint, tokens array<int>"
LAYOUT = {
    "parquet.writer.version": "v2",  # delta encodings for integers without a dictionary
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#tokens.list.element": "true",
    "parquet.block.size": str(8 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}


def _in_files(docs: DataFrame, file_bytes: int) -> DataFrame:
    """``docs`` dealt into files by a sampled range sort of ids, then text hashes, so that no id has to fit one file.

    Equal rows are spread by the task that read them, which a task run anew keeps.
    """
    n_bytes = docs.select(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.withColumn("text_hash", F.xxhash64("text")).withColumn("reader", F.spark_partition_id())
    keys = ("doc_id", "text_hash", "reader")
    dealt = keyed.repartitionByRange(max(1, -(-n_bytes // file_bytes)), *keys).sortWithinPartitions(*keys)
    return dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text")


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    def rows(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        position = 0
        for part, flat, counts in tokens.encoded(batches, vocabulary, end_id):
            ends = np.cumsum(counts)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(flat.view(np.int32)))
            places = pa.array(position + ends - counts)
            yield pa.RecordBatch.from_arrays(
                [part.column("part"), part.column("doc_id"), places, pa.array(counts), lists],
                ["part", "doc_id", "position", "n_tokens", "tokens"],
            )
            position += int(ends[-1])

    _in_files(docs, file_bytes).mapInArrow(rows, SCHEMA).write.options(**LAYOUT).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def file_offsets(written: DataFrame) -> DataFrame:
    """Ids before each file, from the count column alone. Runs of ``RUN`` files are summed first, so that no task holds all files."""
    sums = written.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("run", F.expr(f"part div {RUN}"))
    runs = sums.groupBy(F.col("run").alias("of_run")).agg(F.sum("n").alias("n"))
    runs = runs.select("of_run", (F.sum("n").over(Window.orderBy("of_run")) - F.col("n")).alias("before"))
    inside = F.sum("n").over(Window.partitionBy("run").orderBy("part")) - F.col("n")
    placed = sums.withColumn("inside", inside).join(runs, F.col("run") == F.col("of_run"))
    return placed.select(F.col("part").alias("of_part"), F.expr("before + inside").alias("ahead"))


def checksums(rows: DataFrame) -> DataFrame:
    """``part``, ``doc_id``, ``position``, and count and unsigned crc32 of each row's ids as read from the files."""
    schema = "part int, doc_id bigint, position bigint, n_tokens bigint, ids_crc32 bigint"

    def check(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lists = batch.column("tokens")
            bounds = np.asarray(lists.offsets)
            flat = memoryview(np.ascontiguousarray(np.asarray(lists.values), dtype="<u4")).cast("B")
            sums = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            kept = [batch.column(c) for c in ("part", "doc_id", "position")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(np.diff(bounds).astype(np.int64)), pa.array(sums, pa.int64())],
                ["part", "doc_id", "position", "n_tokens", "ids_crc32"],
            )

    return rows.select("part", "doc_id", "position", "tokens").mapInArrow(check, schema)


def token_report(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Writes the token files of ``docs`` and reports every document as read back from them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, vocabulary or tokens.vocabulary_path())
    written = read_tokens(spark, path)
    offsets = file_offsets(written)
    placed = checksums(written).join(offsets, F.col("part") == F.col("of_part"))
    return placed.selectExpr("doc_id", "ahead + position as start", "n_tokens", "ids_crc32")
