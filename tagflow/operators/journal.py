"""Operators over the change journal: windows, validity, deduplication, eligibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagflow.functions.columns import identity, is_archived, subtract
from tagflow.operators.chains import linked


def window(journal: DataFrame, since: Column | None = None, until: Column | None = None, record_type: str = "UPDATE_METADATA") -> DataFrame:
    """Rows of one type after `since` (excluded) up to `until` (included); all parts reach the scan."""
    out = journal.where(F.col("record_type") == record_type)
    out = out if since is None else out.where(F.col("record_timestamp") > since)
    return out if until is None else out.where(F.col("record_timestamp") <= until)


def validity(ops: DataFrame) -> DataFrame:
    """Adds `error_reason`: null for a good row."""
    reason = F.when(F.coalesce(F.col("key"), F.lit("")) == "", "empty key").when(F.col("object_tags").isNull() | (F.size("object_tags") == 0), "no tags").when(F.col("record_timestamp").isNull(), "no time")
    return ops.withColumn("error_reason", reason)


#: Lengths in microseconds of the slots in which `row_cap_boundary` counts: hours, seconds, single times.
SLOTS = (3_600_000_000, 1_000_000, 1)


def row_cap_boundary(ops: DataFrame, cap: int) -> DataFrame:
    """Timestamp of the row number `cap`; no row where there are fewer (rows without a time are not counted).

    Rows are counted by hour, then by second within the hour that holds the row, then by time within the
    second: only counts are sorted, at most one for each hour, 3,600 seconds and a million times.
    """
    inside = ops.where(F.col("record_timestamp").isNotNull()).select("record_timestamp", F.unix_micros(F.col("record_timestamp").cast("timestamp")).alias("at"))
    wanted = F.lit(cap)
    for width in SLOTS:
        slot = F.floor(F.col("at") / width) if width > 1 else F.col("at")
        per = inside.groupBy(slot.alias("slot"), *(["wanted"] if "wanted" in inside.columns else [])).agg(F.count("*").alias("n"), F.min("record_timestamp").alias("first"))
        upto = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("slot"))
        hit = per.withColumn("upto", upto).where((F.col("upto") >= wanted) & (F.col("upto") - F.col("n") < wanted))
        hit = hit.select(F.col("slot").alias("in_slot"), (wanted - (F.col("upto") - F.col("n"))).alias("wanted"), "first")  # one row at most
        if width > 1:
            inside = inside.drop("wanted").join(F.broadcast(hit.drop("first")), slot == F.col("in_slot")).drop("in_slot")
            wanted = F.col("wanted")
    return hit.select(F.col("first").alias("record_timestamp"))


def with_ties(ops: DataFrame, cap: int) -> DataFrame:
    """The first `cap` rows by time and all that share the last one's time (two passes, no global window)."""
    last = row_cap_boundary(ops, cap).select(F.col("record_timestamp").alias("boundary"))
    bound = last.groupBy().agg(F.max("boundary").alias("boundary"))  # one row
    return ops.join(F.broadcast(bound)).where(F.col("boundary").isNull() | (F.col("record_timestamp") <= F.col("boundary"))).drop("boundary")


def _numbered_times(ops: DataFrame, cap: int) -> DataFrame:
    """Every time of the rows (_time, _n rows) with `batch`, the number of the capped run that reads it; only counts by time are ordered."""
    per = ops.where(F.col("record_timestamp").isNotNull()).groupBy(F.col("record_timestamp").alias("_time")).agg(F.count("*").alias("_n"))
    return linked(per.withColumn("_all", F.lit(0)), ["_all"], ["_time"], "_n", cap, over=True).select("_time", "_n", F.col("link").alias("batch"))


def capped_batches(ops: DataFrame, cap: int) -> DataFrame:
    """Rows with `batch`, the number of the capped run that reads them: each takes rows by time until it has `cap` or more.

    Rows of one time stay together, so the batches are those of `with_ties` applied in a chain, each after the last
    one's boundary. Rows without a time are in no batch.
    """
    numbers = _numbered_times(ops, cap).drop("_n")
    return ops.join(numbers, F.col("record_timestamp") == F.col("_time")).drop("_time")


def capped_windows(ops: DataFrame, cap: int) -> DataFrame:
    """One row for each capped run over the rows: its number, the last time that it reads, and how many rows; all but the last have `cap` or more."""
    return _numbered_times(ops, cap).groupBy("batch").agg(F.max("_time").alias("until"), F.sum("_n").alias("rows"))


def latest(ops: DataFrame) -> DataFrame:
    """One row for each identity: the highest sequence number, with when the identity was first seen.

    Aggregates combine map-side, so a hot identity is not gathered in one task.
    """
    named = ops.withColumn("lid", identity(F.col("bucket"), F.col("key"), F.col("version_id"), F.col("object_tags")))
    row = F.struct(*[F.col(c) for c in ops.columns])
    order = F.struct("sequence_number", F.negative(F.unix_micros(F.col("record_timestamp").cast("timestamp"))))
    first = F.min(F.struct("record_timestamp", "sequence_number"))
    return named.groupBy("lid").agg(F.max_by(row, order).alias("op"), first.alias("first_seen"), F.count("*").alias("deliveries")).select("lid", "op.*", "first_seen", "deliveries")


def eligible(ops: DataFrame, state: DataFrame, processed: DataFrame, lookback_s: int) -> DataFrame:
    """Rows after the bucket's watermark, or in the lookback before it and not yet processed.

    `state` has bucket, watermark and lease_mark (nullable); a bucket without state starts at
    the epoch. Rows at or before a lease mark are in another's hands.
    """
    mark = state.select(F.col("bucket").alias("b"), "watermark", "lease_mark")
    done = processed.select(F.col("lid").alias("done")).distinct()
    joined = ops.join(mark, ops["bucket"] == mark["b"], "left").join(done, ops["lid"] == done["done"], "left")
    ts, wm = F.col("record_timestamp"), F.col("watermark")
    late = (ts > subtract(wm, lookback_s)) & (ts <= wm) & F.col("done").isNull()
    keep = (F.col("lease_mark").isNull() | (ts > F.col("lease_mark"))) & (wm.isNull() | (ts > wm) | late)
    return joined.where(keep).drop("b", "watermark", "lease_mark", "done")


def _beside_marks(rows: DataFrame, state: DataFrame) -> DataFrame:
    mark = state.select(F.col("bucket").alias("b"), F.col("watermark").alias("mark"))
    return rows.join(mark, rows["bucket"] == mark["b"], "left")


def after_marks(ops: DataFrame, state: DataFrame) -> DataFrame:
    """Rows after their bucket's watermark (all, where there is none)."""
    return _beside_marks(ops, state).where(F.col("mark").isNull() | (F.col("record_timestamp") > F.col("mark"))).drop("b", "mark")


def until_marks(processed: DataFrame, state: DataFrame) -> DataFrame:
    """Processed ids up to their bucket's watermark: what a mark that was set back leaves."""
    return _beside_marks(processed, state).where(F.col("mark").isNotNull() & (F.col("watermark") <= F.col("mark"))).drop("b", "mark")


def high_water_mark(ops: DataFrame) -> DataFrame:
    """Latest event time of each bucket over the eligible rows, archived ones included."""
    return ops.groupBy("bucket").agg(F.max("record_timestamp").alias("high_water_mark"))


def without_archived(ops: DataFrame) -> DataFrame:
    """Must follow `latest`: a later archive record replaces the tag record of the same identity."""
    return ops.where(~is_archived(F.col("storage_class")))


def permanent_deletes(journal: DataFrame, since: Column | None = None) -> DataFrame:
    """Distinct (bucket, key, version_id) deleted for good, or whose null version was written over."""
    rows = journal if since is None else journal.where(F.col("record_timestamp") > since)
    deleted = rows.where((F.col("record_type") == "DELETE") & ~F.coalesce("is_delete_marker", F.lit(False)))
    replaced = rows.where(F.col("record_type").isin("PUT", "COPY", "RESTORE") & F.col("version_id").isNull())
    return deleted.select("bucket", "key", "version_id").union(replaced.select("bucket", "key", "version_id")).distinct()
