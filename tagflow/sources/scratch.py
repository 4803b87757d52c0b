"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local folder is made only by a local session that names none (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def written(df: DataFrame, by: str | None = None) -> DataFrame:
    """`df` as a table of the shared folder: its rows stay as they are now, whatever executors are lost. Rows with one value of `by` have a folder of their own."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4()}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
