"""Registered queries over the jobs of earlier runs, with the SQL of their rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tagflow.plans import catalogue as C
from tagflow.plans import prior_jobs as K
from tagflow.plans.tracking import ITEMS
from tagflow.sources.items import ItemTable
from tagflow.sources.scratch import shared_folder
from tagflow.sources.sinks import StateStore

#: Four jobs a bucket: one complete, one failed, one that still runs, one that could not be asked.
TOLD = C.REPORT + ", told AS (SELECT *, CAST(sequence_number AS BIGINT) % 4 AS k, bucket || '-' || CAST(CAST(sequence_number AS BIGINT) % 4 AS VARCHAR) AS job_id FROM rep)"


def _jobs(spark, sf):
    """Records, statuses and report rows of the jobs."""
    k = F.col("sequence_number").cast("long") % 4
    rows = C.parsed(spark, sf).withColumns({"k": k, "position": F.col("sequence_number").cast("long"), "job_id": F.concat("bucket", F.lit("-"), k.cast("string")), "result_message": F.concat(F.lit("m"), "sequence_number")})
    made = rows.select("bucket", "k", "job_id").distinct()
    config = F.concat(F.lit("c"), F.col("k").cast("string"))
    seen = (F.col("k") == 1) & (F.col("bucket") == "lake-1")
    records = made.select("bucket", config.alias("config_id"), "job_id", C.ntz(C.MARK).alias("manifest_at"), F.lit("").alias("watermark_low"), F.lit(0).alias("consecutive_failures"), seen.alias("report_diagnosed"))
    status = F.when(F.col("k") == 0, "Complete").when(F.col("k") == 1, "Failed").otherwise("Active")
    statuses = made.where("k < 3").select("job_id", status.alias("status"), F.lit(1).cast("long").alias("tasks_succeeded"), F.lit(1).cast("long").alias("tasks_failed"))
    return records, statuses, rows.select("job_id", "position", "bucket", "key", "version_id", "error_code", "result_message")


def _inspected(spark, sf, times):
    records, statuses, reports = _jobs(spark, sf)
    stored = C.manifest(spark, sf).where(F.length("key") % 2 == 0).select("bucket", "key", "version_id", "tagged_at", "rules", "destinations")
    folder = f"{shared_folder(spark)}/prior-{uuid.uuid4()}"
    table = ItemTable(spark, StateStore(spark, f"{folder}/state"), folder, ITEMS, 8)
    none = spark.createDataFrame([], "bucket string, config_id string")
    found = [K.inspected(table, records, statuses, reports, stored, none, folder) for _ in range(times)]
    failed = {k: v for x in found for k, v in x.errors.items()}
    if failed:
        raise RuntimeError(str(failed))
    return table, found


@C.query(TOLD + """ SELECT t.bucket, t.key, t.version_id, string_agg(DISTINCT 'c' || k || ':' || job_id, ',' ORDER BY 'c' || k || ':' || job_id) AS configs, 'PENDING' AS state, max(mf.tagged_at) AS tagged_at, coalesce(max(mf.rules), '') AS rules
FROM told t LEFT JOIN mf ON mf.bucket = t.bucket AND mf.key = t.key AND mf.version_id IS NOT DISTINCT FROM t.version_id AND length(mf.key) % 2 = 0 WHERE k < 2 GROUP BY t.bucket, t.key, t.version_id""")
def prior_jobs_merged(spark, sf):
    """Tracked objects after the reports of ended jobs were merged, and the jobs looked at once more."""
    table, _ = _inspected(spark, sf, 2)
    told = F.array_join(F.array_sort(F.transform(F.map_entries("configs"), lambda e: F.concat(e["key"], F.lit(":"), e["value"]["job_id"]))), ",")
    return table.items().select("bucket", "key", "version_id", told.alias("configs"), "state", "tagged_at", F.coalesce(F.concat_ws(",", "rules"), F.lit("")).alias("rules"))


@C.query(TOLD + """ SELECT job_id, error_code, count(*) AS n, 'm' || min(sequence_number) AS message, CASE error_code WHEN 'AccessDenied' THEN 'the job''s role lacks a permission' ELSE 'a task failed: m' || min(sequence_number) END AS cause
FROM told WHERE k < 2 AND error_code IS NOT NULL AND NOT (bucket = 'lake-1' AND k = 1) GROUP BY job_id, error_code""")
def prior_jobs_diagnosed(spark, sf):
    """Task errors of ended jobs whose reports were not diagnosed before."""
    _, found = _inspected(spark, sf, 1)
    return found[0].diagnoses
