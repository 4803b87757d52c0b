"""What became of the jobs of earlier runs: their outcomes for recovery, their reports merged into tracked objects and diagnosed.

All jobs of all buckets go through one plan; a report is read for jobs that have ended and were not merged, or not diagnosed.
Merging and diagnosing may fail without any effect on the outcomes that recovery works with.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.operators import state as S
from tagflow.operators import tracking as T
from tagflow.plans import interval as I
from tagflow.sources.items import ItemTable
from tagflow.sources.sinks import StateStore

#: Submissions on record, one for a bucket; `manifest_at` is when the job was made.
RECORDS = "bucket string, config_id string, job_id string, manifest_at timestamp_ntz, watermark_low string, consecutive_failures int, report_diagnosed boolean"
#: Rows of reports, with the job that each belongs to and its place in the report.
REPORTS = "job_id string, position long, bucket string, key string, version_id string, error_code string, result_message string"
DIAGNOSES = "job_id string, error_code string, n long, message string, cause string"


@dataclass
class Inspected:
    """What an inspection found: `outcomes` (for `run_interval`), causes of task errors, the alerts still out, partitions of tracked objects
    rewritten, and what failed on the way (`merge` or `diagnosis`: its error)."""

    outcomes: DataFrame
    diagnoses: DataFrame
    alerted: DataFrame
    rewritten: list[int] = field(default_factory=list)
    errors: dict[str, str] = field(default_factory=dict)


def records_of(spark: SparkSession, store: StateStore) -> DataFrame:
    """The submissions that the interval's state holds (columns RECORDS); the config of a bucket is named as the bucket is."""
    document, _ = store.read(I.STATE)
    held = [(b, e["submission"]) for b, e in (document or {"buckets": {}})["buckets"].items() if e.get("submission")]
    rows = [(b, b, x["job"], I._time(x.get("at")), x.get("low") or "", int(x.get("failures", 0)), bool(x.get("diagnosed"))) for b, x in held]
    return spark.createDataFrame(rows, RECORDS)


def note_diagnosed(store: StateStore, jobs: list[str]) -> None:
    """Set on the records of `jobs` that their reports were diagnosed; a record that another submission replaced stays as it is."""

    def change(document: dict | None) -> dict:
        document = document or {"buckets": {}, "window": None}
        buckets = dict(document["buckets"])
        for b, e in buckets.items():
            if e.get("submission") and e["submission"]["job"] in jobs:
                buckets[b] = e | {"submission": e["submission"] | {"diagnosed": True}}
        return document | {"buckets": buckets}

    if jobs:
        store.update(I.STATE, change)


def report_updates(ended: DataFrame, reports: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows for `ItemTable.merge`: each object of a report gets the entry of its job's config, confirmed, whatever its task came to.

    What was stored of an object (tagged_at, rules, destinations) is what it starts with. Of several jobs of one config the one made last
    holds, and of several rows of one report the last.
    """
    j = F.broadcast(ended.select(F.col("job_id").alias("j"), "config_id", "manifest_at"))  # one row a bucket
    rows = reports.join(j, reports["job_id"] == j["j"])
    entry = F.struct("job_id", "manifest_at", F.lit(True).alias("confirmed"))
    first = stored.groupBy(*T.OBJECT).agg(*(F.min_by(c, "tagged_at").alias(c) for c in ("tagged_at", "rules", "destinations")))
    told = rows.select("job_id", *T.OBJECT, F.struct("manifest_at", "job_id", "position").alias("told"), F.create_map("config_id", entry).alias("configs"))
    return T.with_stored(told, first)


def inspected(table: ItemTable, records: DataFrame, statuses: DataFrame, reports: DataFrame, stored: DataFrame, alerted: DataFrame, folder: str) -> Inspected:
    """Look at the jobs on record: `statuses` (job_id, status, tasks_succeeded, tasks_failed) has those that could be asked.

    A job that could not be asked, or has not ended, is left for the next run. One that ended and has no row in `reports` (columns
    REPORTS) yet is not merged and not diagnosed; one that was merged before is not merged again. `stored` has what is known of objects
    beside the journal, `alerted` (bucket, config_id) the alerts out for reports that did not come; merging a report clears its
    config's. `folder` is shared storage.
    """
    spark = records.sparkSession
    s = statuses.select(F.col("job_id").alias("s_job"), "status", "tasks_succeeded", "tasks_failed").dropDuplicates(["s_job"])
    asked = records.join(s, records["job_id"] == s["s_job"]).drop("s_job")
    failed = S.effective_failure(F.col("status"), F.col("tasks_succeeded"), F.col("tasks_failed"))
    run = f"{folder.rstrip('/')}/inspected-{uuid.uuid4()}"
    asked.withColumn("failed", failed).write.parquet(f"{run}/jobs")
    jobs = spark.read.schema(f"{RECORDS}, status string, tasks_succeeded long, tasks_failed long, failed boolean").parquet(f"{run}/jobs")
    ended = jobs.where(F.col("status").isin(T.TERMINAL))
    out = Inspected(jobs, spark.createDataFrame([], DIAGNOSES), alerted)
    try:
        fresh = T.unmerged_jobs(ended, table.merged_jobs())
        fresh.write.parquet(f"{run}/fresh")
        fresh = spark.read.schema(ended.schema).parquet(f"{run}/fresh")
        out.rewritten = table.merge(report_updates(fresh, reports, stored), "told")
        came = fresh.join(table.merged_jobs().withColumnRenamed("job_id", "done"), F.col("job_id") == F.col("done"), "left_semi")
        out.alerted = T.alerted(alerted, alerted.limit(0), came.select("bucket", "config_id"))
    except Exception as e:  # noqa: BLE001 - recovery goes on whatever a merge raises; the jobs are merged in the next run
        out.errors["merge"] = str(e).splitlines()[0][:500] if str(e) else type(e).__name__
    try:
        open_jobs = F.broadcast(ended.where(~F.coalesce("report_diagnosed", F.lit(False))).select(F.col("job_id").alias("j")))
        rows = reports.join(open_jobs, reports["job_id"] == open_jobs["j"]).drop("j")
        T.error_diagnoses(rows).write.parquet(f"{run}/diagnoses")
        out.diagnoses = spark.read.schema(DIAGNOSES).parquet(f"{run}/diagnoses")
    except Exception as e:  # noqa: BLE001 - as above
        out.errors["diagnosis"] = str(e).splitlines()[0][:500] if str(e) else type(e).__name__
    return out


def told_of(found: Inspected, reports: DataFrame) -> list[str]:
    """Jobs whose reports were there to be diagnosed (at most one a bucket); none where the diagnosis failed."""
    if "diagnosis" in found.errors:
        return []
    ended = found.outcomes.where(F.col("status").isin(T.TERMINAL)).select(F.col("job_id").alias("j"))
    return [r.j for r in ended.join(reports.select("job_id").distinct(), F.col("j") == F.col("job_id"), "left_semi").collect()]


def with_outcomes(table: ItemTable, store: StateStore, statuses: DataFrame, reports: DataFrame, stored: DataFrame, alerted: DataFrame, folder: str) -> Inspected:
    """Inspect the jobs on the interval's record and note which reports were diagnosed; hand `outcomes` of the result to `run_interval`."""
    found = inspected(table, records_of(table.spark, store), statuses, reports, stored, alerted, folder)
    note_diagnosed(store, told_of(found, reports))
    return found
