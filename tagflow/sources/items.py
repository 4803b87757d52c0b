"""Tracked objects as a partitioned table of which a merge rewrites only what it touches.

Objects are dealt to partitions by a hash of their identity. A generation is one versioned document: the folder that holds
each partition now, and the folders with the ids of merged jobs. It is written last, over the generation that was
read, so items and job ids change together or not at all, and what a failed merge left behind is named by none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.operators import state as S
from tagflow.sources.scratch import written
from tagflow.sources.sinks import StateStore

NAME = "items"


class ItemTable:
    """Tracked objects of all buckets, with `schema` (bucket, key, version_id, configs, state, ...), in `partitions` parts."""

    def __init__(self, spark: SparkSession, store: StateStore, folder: str, schema: str, partitions: int = 256) -> None:
        self.spark, self.store, self.folder, self.schema, self.partitions = spark, store, folder.rstrip("/"), schema, partitions

    def _document(self) -> tuple[dict, int | None]:
        document, version = self.store.read(NAME)
        return document or {"partitions": self.partitions, "parts": {}, "jobs": []}, version

    def _part(self, document: dict) -> Column:
        """The partition of an object; its number stands in the document, so it is the same for every merge."""
        null = F.col("version_id").isNull()
        return F.pmod(F.xxhash64("bucket", "key", "version_id", null), F.lit(document["partitions"])).cast("int")

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def items(self) -> DataFrame:
        document, _ = self._document()
        return self._read(sorted(document["parts"].values()), self.schema)

    def merged_jobs(self) -> DataFrame:
        document, _ = self._document()
        return self._read(document["jobs"], "job_id string")

    def merge(self, rows: DataFrame, order: str | None = None) -> list[int]:
        """Take in report rows (job_id, object, configs, and what new objects start with); returns the partitions rewritten.

        Rows of jobs that were merged before change nothing. At most `partitions` numbers reach the driver.
        """
        document, version = self._document()
        done = self._read(document["jobs"], "job_id string").select(F.col("job_id").alias("__done")).distinct()
        # written once: what is touched, merged and noted is the same rows, and what they come from is not made again for each
        new = written(rows.join(done, rows["job_id"].cast("string") == done["__done"], "left_anti").withColumn("__part", self._part(document)))
        touched = sorted(r[0] for r in new.select("__part").distinct().collect())
        if not touched:
            return []
        run = f"{self.folder}/{uuid.uuid4()}"
        old = self._read([document["parts"][str(k)] for k in touched if str(k) in document["parts"]], self.schema)
        merged = S.upsert(old, new.drop("__part"), order).withColumn("__part", self._part(document))
        # a part is one folder; several tasks may write to it
        merged.repartition("__part").write.partitionBy("__part").parquet(f"{run}/items")
        new.select(F.col("job_id").cast("string").alias("job_id")).distinct().write.parquet(f"{run}/jobs")
        parts = document["parts"] | {str(k): f"{run}/items/__part={k}" for k in touched}
        self.store.write(NAME, document | {"parts": parts, "jobs": [*document["jobs"], f"{run}/jobs"]}, version)
        return touched
