"""Tracked objects and jobs after a submission: merging, resolving, publishing, and what is remembered beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statuses after which a job does nothing more, and error codes with a cause of their own.
TERMINAL = ["Complete", "Failed", "Cancelled"]
PERMISSION_CODES = ["InitiateReplicationNotPermitted", "AccessDenied"]
NOT_ELIGIBLE = "SrcObjectNotEligible"
OBJECT = ("bucket", "key", "version_id")


def same_object(a: DataFrame, b: DataFrame) -> Column:
    """Both rows are of one object; null versions are equal."""
    return (a["bucket"] == b["bucket"]) & (a["key"] == b["key"]) & a["version_id"].eqNullSafe(b["version_id"])


def _keyed(rows: DataFrame, *columns: Column) -> DataFrame:
    """The object's columns under other names, and some more."""
    return rows.select(*(F.col(c).alias(f"o_{c}") for c in OBJECT), *columns)


def _same(a: DataFrame, b: DataFrame) -> Column:
    return (a["bucket"] == b["o_bucket"]) & (a["key"] == b["o_key"]) & a["version_id"].eqNullSafe(b["o_version_id"])


def unmerged_jobs(jobs: DataFrame, merged: DataFrame) -> DataFrame:
    """Terminal jobs (job_id, status) whose report was not merged before (`merged` has job_id)."""
    m = merged.select(F.col("job_id").alias("done")).distinct()
    over = jobs.where(F.col("status").isin(TERMINAL))
    return over.join(m, over["job_id"] == m["done"], "left_anti")


def with_stored(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Report rows with what was stored of their objects (tagged_at, rules, destinations), null where nothing was."""
    s = _keyed(stored, F.col("tagged_at"), F.col("rules"), F.col("destinations"))
    return rows.join(s, _same(rows, s), "left").drop(*(f"o_{c}" for c in OBJECT))


def inserted_if_absent(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """The stored rows, and the fresh ones of objects that have none: what is stored first stays."""
    s = _keyed(stored)
    return stored.unionByName(fresh.select(*stored.columns).join(s, _same(fresh, s), "left_anti"))


def resolved(items: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Items with the outcomes of `resolutions` (object, outcome, resolved_at); a resolution without an item is dropped.

    A null outcome leaves an item as it is, and an item that is resolved already keeps its own.
    """
    r = _keyed(resolutions.where("outcome IS NOT NULL"), F.col("outcome").alias("_outcome"), F.col("resolved_at").alias("_at"))
    joined = items.join(r, _same(items, r), "left")
    now = (F.col("state") == "PENDING") & F.col("_outcome").isNotNull()
    changed = {"outcome": F.when(now, F.col("_outcome")).otherwise(F.col("outcome")), "resolved_at": F.when(now, F.col("_at")).otherwise(F.col("resolved_at")), "state": F.when(now, "RESOLVED").otherwise(F.col("state"))}
    return joined.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in items.columns))


def without_published(rows: DataFrame, published: DataFrame) -> DataFrame:
    """Items, or rows stored beside them, without those of published objects."""
    p = _keyed(published)
    return rows.join(p, _same(rows, p), "left_anti")


def error_diagnoses(rows: DataFrame) -> DataFrame:
    """Per job and error code of report rows (job_id, position, error_code, result_message): count, first message, cause."""
    bad = rows.where("error_code <> ''")
    per = bad.groupBy("job_id", "error_code").agg(F.count("*").alias("n"), F.min_by("result_message", "position").alias("message"))
    cause = (
        F.when(F.col("error_code").isin(PERMISSION_CODES), "the job's role lacks a permission")
        .when(F.col("error_code") == NOT_ELIGIBLE, "the object is not eligible, most often because it is archived")
        .otherwise(F.concat(F.lit("a task failed"), F.coalesce(F.concat(F.lit(": "), "message"), F.lit(""))))
    )
    return per.select("job_id", "error_code", "n", "message", cause.alias("cause"))


def alerted(known: DataFrame, added: DataFrame, cleared: DataFrame) -> DataFrame:
    """The set of configs (bucket, config_id) with an alert out, after some are added and then some cleared."""
    whole = known.select("bucket", "config_id").union(added.select("bucket", "config_id")).distinct()
    gone = cleared.select(F.col("bucket").alias("cb"), F.col("config_id").alias("cc"))
    return whole.join(gone, (whole["bucket"] == gone["cb"]) & (whole["config_id"] == gone["cc"]), "left_anti")


def diagnosed(submissions: DataFrame, jobs: DataFrame) -> DataFrame:
    """Submissions with `report_diagnosed` set for the jobs whose report was looked at (`jobs` has job_id)."""
    j = jobs.select(F.col("job_id").alias("seen")).distinct().withColumn("_now", F.lit(True))
    joined = submissions.join(j, submissions["job_id"] == j["seen"], "left")
    return joined.withColumn("report_diagnosed", F.coalesce("_now", "report_diagnosed", F.lit(False))).drop("seen", "_now")


def enabled(buckets: DataFrame, flags: DataFrame) -> DataFrame:
    """Buckets that are not disabled; one whose flag could not be read (`flags`: bucket, disabled, readable) is left out too."""
    f = flags.select(F.col("bucket").alias("fb"), ((~F.coalesce("readable", F.lit(True))) | F.coalesce("disabled", F.lit(False))).alias("out")).where("out")
    return buckets.join(f, buckets["bucket"] == f["fb"], "left_anti")


def publishable(items: DataFrame, scans: DataFrame) -> DataFrame:
    """Resolved items all of whose configs are quiet: scanned after their manifest, with nothing found (no configs: at once).

    `configs` maps a config id to a struct with manifest_at; `scans` has config_id, last_scan_at, last_scan_match_count.
    """
    c = items.where("state = 'RESOLVED'").select(*OBJECT, F.explode("configs").alias("config_id", "config"))
    s = scans.select(F.col("config_id").alias("sc"), "last_scan_at", "last_scan_match_count")
    quiet = F.coalesce((F.col("last_scan_at") > F.col("config.manifest_at")) & (F.col("last_scan_match_count") == 0), F.lit(False))
    loud = c.join(s, c["config_id"] == s["sc"], "left").where(~quiet).select(*OBJECT).distinct()
    return without_published(items.where("state = 'RESOLVED'"), loud)
