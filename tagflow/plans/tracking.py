"""One tracking interval: check pending objects, apply what is found, publish what is finished, then forget it."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.operators import reports as P
from tagflow.operators import state as S
from tagflow.operators import tracking as T
from tagflow.operators.settings import Settings

#: Columns of tracked objects; `configs` maps a config id to its job, the time of its manifest and whether the job's report came.
ITEMS = """bucket string, key string, version_id string, configs map<string,struct<job_id:string,manifest_at:timestamp_ntz,confirmed:boolean>>, state string,
outcome string, resolved_at timestamp_ntz, tagged_at timestamp_ntz, rules array<string>, destinations array<string>"""
Publish = Callable[[DataFrame], None]


@dataclass
class Tracked:
    """What an interval did: the items left (a table), and how many were checked, resolved and published."""

    items: DataFrame
    checked: int
    resolved: int
    published: int


def newest_manifest() -> Column:
    return F.array_max(F.transform(F.map_values("configs"), lambda c: c["manifest_at"]))


def oldest_manifest() -> Column:
    return F.array_min(F.transform(F.map_values("configs"), lambda c: c["manifest_at"]))


def candidates(items: DataFrame, batch: int) -> DataFrame:
    """Pending objects whose configs are all confirmed, those with the oldest manifest first, at most `batch` (the feature)."""
    ready = items.where((F.col("state") == "PENDING") & F.forall(F.map_values("configs"), lambda c: F.coalesce(c["confirmed"], F.lit(False))))
    return ready.withColumn("oldest", oldest_manifest()).orderBy(F.asc_nulls_first("oldest"), "bucket", "key", F.asc_nulls_first("version_id")).limit(batch).drop("oldest")


def resolutions(checked: DataFrame, statuses: DataFrame, now: Column, ttl_s: int) -> DataFrame:
    """Object, outcome (null: still pending) and time of the checked objects.

    One tracked for longer than `ttl_s` since its newest manifest expires without a look at its status (bucket, key,
    version_id, kind, value); one whose status is not there or failed is left as it is.
    """
    s = statuses.select(*(F.col(c).alias(f"o_{c}") for c in T.OBJECT), "kind", "value")
    joined = checked.join(s, (checked["bucket"] == s["o_bucket"]) & (checked["key"] == s["o_key"]) & checked["version_id"].eqNullSafe(s["o_version_id"]), "left")
    outcome = S.reconcile(F.col("kind"), F.col("value"), S.expired(newest_manifest(), now, ttl_s))
    return joined.select(*T.OBJECT, F.when(outcome != "PENDING", outcome).alias("outcome"), now.alias("resolved_at"))


def run_tracking(items: DataFrame, scans: DataFrame, statuses: DataFrame, publish: Publish, folder: str, settings: Settings, now: Column) -> Tracked:
    """Run one tracking interval over the tracked objects (columns ITEMS) of all buckets; `folder` is shared storage.

    `publish(report)` is handed one row for each bucket and must raise if the report did not go out; only then
    are the published objects left out of the items that stay, so a report goes out once at least. What
    was resolved is written before anything is published.
    """
    spark, run = items.sparkSession, f"{folder}/tracking-{uuid.uuid4()}"
    candidates(items, settings.check_batch).write.parquet(f"{run}/checked")
    checked = spark.read.schema(items.schema).parquet(f"{run}/checked")
    found = resolutions(checked, statuses, now, settings.tracking_ttl_s)
    T.resolved(items, found).write.parquet(f"{run}/items")
    kept = spark.read.schema(items.schema).parquet(f"{run}/items")
    T.publishable(kept, scans).write.parquet(f"{run}/published")
    ready = spark.read.schema(items.schema).parquet(f"{run}/published")
    counts = checked.count(), found.where("outcome IS NOT NULL").count(), ready.count()
    if not counts[2]:
        return Tracked(kept, *counts)
    left = T.without_published(kept, ready)
    outstanding = kept.select("bucket").distinct().join(left.groupBy("bucket").agg(F.count("*").alias("outstanding")), "bucket", "left").fillna(0, ["outstanding"])
    try:
        publish(P.outcome_summary(ready, outstanding))
    except Exception:  # noqa: BLE001 - a report that did not go out leaves its objects where they are, for the next run
        return Tracked(kept, counts[0], counts[1], 0)
    left.write.parquet(f"{run}/left")
    return Tracked(spark.read.schema(items.schema).parquet(f"{run}/left"), *counts)
