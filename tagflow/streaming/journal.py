"""Structured Streaming over the journal."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.functions.columns import identity
from tagflow.operators import journal as J
from tagflow.sources.journal import from_events


def deduplicated(stream: DataFrame, delay: str = "2 hours") -> DataFrame:
    """One row for each identity within the delay; state is dropped as the watermark passes.

    A row counts as seen when it arrives. The batch operators count it as processed only when
    its manifest was submitted; `in_batches` keeps that form.
    """
    ops = J.window(stream, None, None).withColumn("event_time", F.col("record_timestamp").cast("timestamp"))
    named = ops.withColumn("lid", identity(F.col("bucket"), F.col("key"), F.col("version_id"), F.col("object_tags")))
    return named.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["lid"])


def in_batches(stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str):
    """Start a query that hands every micro-batch to `run`, which commits its own state."""
    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_dedup_within_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """The events journal as a bounded stream: read, deduplicated, written to a table, and read back."""
    path = f"{sf}/events.parquet"
    schema = spark.read.parquet(path).schema
    folder = f"{_folder(spark)}/stream-{uuid.uuid4()}"
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path if _is_folder(spark, path) else f"{sf}/events*.parquet")
    out = deduplicated(from_events(stream)).select("bucket", "key", "version_id", "sequence_number", "record_timestamp")
    query = out.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{folder}/rows")


def _folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return named or tempfile.mkdtemp(prefix="stream-")


def _is_folder(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
