"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # HotSpot never compiles methods above 8000 bytes. Wide projections fused into one method
    # would run interpreted; above this limit Spark generates split, compilable methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The fact and marts compile more code blocks than the default of 100 keeps.
    "spark.sql.codegen.cache.maxEntries": "1000",
    # Call-site capture costs milliseconds of driver time per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above. ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made only in local mode with the setting unset;
    on a cluster the missing setting is an error, since executors could not read it.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured is None and current is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tidemark-")
    if current is None:
        context.setCheckpointDir(configured)
    return (configured or current).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders that nothing will read again."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
