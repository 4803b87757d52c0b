"""Checkpoint state, recovery, tracking and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.functions.columns import subtract
from tagflow.operators.chains import linked, placed


def prune(references: DataFrame, marks: DataFrame, lookback_s: int) -> DataFrame:
    """Processed window: latest time of each id, of those after the window's start (no mark: all)."""
    m = marks.select(F.col("bucket").alias("mb"), "watermark")
    kept = references.join(m, references["bucket"] == m["mb"], "left").where(F.col("watermark").isNull() | (F.col("record_timestamp") > subtract(F.col("watermark"), lookback_s)))
    return kept.groupBy("bucket", "lid").agg(F.max("record_timestamp").alias("watermark"))


def advance(state: DataFrame, high: DataFrame, submitted: DataFrame) -> DataFrame:
    """Watermarks move forward only, and only for buckets with a submission."""
    s = submitted.select(F.col("bucket").alias("sb")).distinct().withColumn("sent", F.lit(True))
    h = high.select(F.col("bucket").alias("hb"), "high_water_mark")
    joined = state.join(h, state["bucket"] == h["hb"], "left").join(s, state["bucket"] == s["sb"], "left")
    moved = F.when(F.col("sent"), F.greatest("watermark", "high_water_mark")).otherwise(F.col("watermark"))
    return joined.select("bucket", moved.alias("watermark"))


def effective_failure(status: Column, ok: Column, bad: Column) -> Column:
    """Failed or cancelled, or complete with nothing done and something failed."""
    return F.coalesce(status.isin("Failed", "Cancelled") | ((status == "Complete") & (ok == 0) & (bad > 0)), F.lit(False))


def recovery_plan(outcomes: DataFrame, threshold: int) -> DataFrame:
    """Per bucket: the failures to go on from, the lowest known start of failed jobs, and whether to disable."""
    bad = F.col("failed")
    return outcomes.withColumn("failed", effective_failure(F.col("status"), F.col("tasks_succeeded"), F.col("tasks_failed"))).groupBy("bucket").agg(
        F.coalesce(F.max(F.when(bad, F.col("consecutive_failures") + 1)), F.lit(0)).alias("consecutive_failures"),
        F.min(F.when(bad & (F.col("watermark_low") != ""), F.col("watermark_low"))).alias("rollback_to"),
        F.count_if(bad & (F.col("watermark_low") == "")).alias("skipped_empty"),
    ).withColumn("disable", F.col("consecutive_failures") >= threshold)


def upsert(items: DataFrame, rows: DataFrame, order: str | None = None) -> DataFrame:
    """Tracked objects after report rows: new ones are pending, known ones get the rows' config entries and keep all else.

    `items` has bucket, key, version_id, configs (a map by config id), state and any other columns; `rows` has the
    object, configs, and of the other columns what a new object starts with. Of several entries of one config the last
    by `order` holds; null versions match.
    """
    objects = ["bucket", "key", "version_id"]
    given = [c for c in items.columns if c in rows.columns and c not in (*objects, "configs", "state")]
    last = F.col(order) if order else F.lit(0)
    entries = rows.select(*objects, *given, last.alias("__order"), F.explode_outer("configs").alias("__config", "__entry"))
    each = entries.groupBy(*objects, "__config").agg(F.max_by("__entry", "__order").alias("__entry"), *(F.max_by(c, "__order").alias(c) for c in given), F.max("__order").alias("__order"))
    named = F.collect_list(F.when(F.col("__config").isNotNull(), F.struct("__config", "__entry")))  # the configs of one object
    new = each.groupBy(*objects).agg(F.map_from_entries(named).alias("configs"), *(F.max_by(c, "__order").alias(c) for c in given))
    a, b = items.alias("a"), new.alias("b")
    same = (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.key") == F.col("b.key")) & F.col("a.version_id").eqNullSafe(F.col("b.version_id"))
    mine, theirs = F.col("a.configs"), F.col("b.configs")
    kept = F.map_filter(mine, lambda k, _: ~F.map_contains_key(theirs, k))
    configs = F.when(F.col("a.bucket").isNull(), theirs).when(theirs.isNull(), mine).when(mine.isNull(), theirs).otherwise(F.map_concat(kept, theirs))
    known = F.col("a.bucket").isNotNull()

    def column(c: str) -> Column:
        if c in objects:
            return F.coalesce(f"a.{c}", f"b.{c}")
        if c == "configs":
            return configs
        if c == "state":
            return F.when(known, F.col("a.state")).otherwise("PENDING")
        return F.when(known, F.col(f"a.`{c}`")).otherwise(F.col(f"b.`{c}`")) if c in given else F.col(f"a.`{c}`")

    return a.join(b, same, "full_outer").select(*(column(c).alias(c) for c in items.columns))


def check_candidates(items: DataFrame, batch: int) -> DataFrame:
    """Pending objects whose configs are all confirmed, oldest first."""
    ready = items.where((F.col("state") == "PENDING") & F.forall(F.map_values("configs"), lambda c: c))
    return ready.orderBy(F.asc_nulls_first("manifest_at"), "bucket", "key", F.asc_nulls_first("version_id")).limit(batch)


def reconcile(kind: Column, value: Column, over: Column) -> Column:
    """Outcome of a pending object; null leaves it pending.

    An object tracked for too long expires without a check. Else a completed header is COMPLETE, any other
    header stands as it is, a missing one is UNKNOWN, and an object that is gone is GONE.
    """
    header = F.when(value == "COMPLETED", "COMPLETE").otherwise(value)
    return F.when(over, "EXPIRED").when(kind == "OBJECT_GONE", "GONE").when(kind == "HEADER_ABSENT", "UNKNOWN").when(kind == "HEADER_VALUE", header)


def expired(at: Column, now: Column, ttl_s: int) -> Column:
    return F.lit(False) if ttl_s <= 0 else F.coalesce(subtract(now, ttl_s) > at, F.lit(False))


def quiescent(scan_at: Column, matches: Column, manifest_at: Column) -> Column:
    return F.coalesce((scan_at > manifest_at) & (matches == 0), F.lit(False))


def outcome_groups(items: DataFrame) -> DataFrame:
    """Report groups by bucket, rules and destinations: counts by outcome and the range of tag times."""
    keys = ["bucket", "rules", "destinations"]
    per = items.groupBy(*keys, "outcome").agg(F.count("*").alias("n"), F.min("tagged_at").alias("lo"), F.max("tagged_at").alias("hi"))
    counts = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("outcome", F.lit("UNKNOWN")).alias("k"), F.col("n").alias("v")))))
    return per.groupBy(*keys).agg(F.sum("n").alias("items"), counts.alias("outcomes"), F.min("lo").alias("first_tagged"), F.max("hi").alias("last_tagged"))


def chunked_groups(groups: DataFrame, order: list[str], budget: int) -> DataFrame:
    """Report groups (bucket, size, ...) with `chunk`: in order, each in the chunk before it if its bytes fit, else in the next.

    A group larger than the budget is alone; no group is split. A bucket may have any number of groups.
    """
    return linked(groups, ["bucket"], order, "size", budget).withColumnRenamed("link", "chunk").drop("pos")


def ordered_references(references: DataFrame) -> DataFrame:
    """References (bucket, lid, record_timestamp) with `pos`, their place in the stored order of their bucket: by time, then id.

    The order is a sort over ranges; places come from counts of the ranges before, not from one task for each bucket.
    """
    rows = placed(references.withColumn("__one", F.lit(1)), ["bucket"], ["record_timestamp", "lid"], "__one")
    return rows.select("bucket", "lid", "record_timestamp", (F.col("pos") + 1).alias("pos"))


def record_submissions(known: DataFrame, fresh: DataFrame) -> DataFrame:
    """Submissions after a run: a bucket with a fresh one keeps only that."""
    b = fresh.select(F.col("bucket").alias("fb")).distinct()
    return known.join(b, known["bucket"] == b["fb"], "left_anti").unionByName(fresh.select(*known.columns))


def record_scans(scans: DataFrame, found: DataFrame, now: Column) -> DataFrame:
    """Latest scan of every config: the count found now, zero where nothing was."""
    f = found.select(F.col("config_id").alias("fc"), "matches")
    joined = scans.select("config_id").join(f, scans["config_id"] == f["fc"], "full_outer")
    return joined.select(F.coalesce("config_id", "fc").alias("config_id"), now.alias("last_scan_at"), F.coalesce("matches", F.lit(0)).cast("long").alias("last_scan_match_count"))


def seeded(configured: DataFrame, state: DataFrame, start: Column) -> DataFrame:
    """First state rows of configured buckets that have none."""
    s = state.select(F.col("bucket").alias("sb"))
    return configured.join(s, configured["bucket"] == s["sb"], "left_anti").select("bucket", start.alias("watermark"))
