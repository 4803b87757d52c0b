"""Completion reports, metric rows, overdue reports and alert limits, as columns over small aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.operators.chains import linked
from tagflow.sources.scratch import written

# What a summary says of each outcome (worst first), for many objects and for one.
PHRASES = [
    ("FAILED", "failed to replicate", "failed to replicate"),
    ("EXPIRED", "were abandoned after the tracking window expired", "was abandoned after the tracking window expired"),
    ("UNKNOWN", "reported no replication status", "reported no replication status"),
    (None, "reported no replication status", "reported no replication status"),
    ("PENDING", "are still replicating", "is still replicating"),
    ("GONE", "were deleted before replication could be confirmed", "was deleted before replication could be confirmed"),
    ("COMPLETE", "replicated successfully", "replicated successfully"),
]
# Outcomes that need action, the words of the verdict, of what is left, and of the subject line, and their limits.
ACTIONABLE = ("FAILED", "EXPIRED", "UNKNOWN", None)
ACTION, BAD, FINE, ALL_FINE = "Action needed: ", " did not replicate.", "No failures.", "No action needed."
NONE_LEFT, ONE_LEFT, MANY_LEFT = " No objects remain in tracking.", " 1 object remains in tracking.", " objects remain in tracking."
SUBJECT, SUBJECT_BAD, SUBJECT_FINE, SUBJECT_LEFT = "S3 replication ", ", action needed", ", no failures", " still tracking"
SUBJECT_CHARS, OVERDUE_S = 100, 3600


def _counted(n: Column) -> Column:
    return F.format_number(n, 0)


def outcome_summary(items: DataFrame, outstanding: DataFrame | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """One row for each bucket: item_count, actionable, summary sentence and subject line.

    `items` has bucket and outcome (null: unknown); `outstanding` has bucket and outstanding, and a
    bucket without a row there says nothing of it. Outcomes are counted map-side. `within` are columns that divide
    the objects of a bucket further, into a row each.
    """
    is_ = lambda o: F.col("outcome").isNull() if o is None else F.col("outcome") == o
    n = [f"n{k}" for k in range(len(PHRASES))]
    per = items.groupBy("bucket", *within).agg(F.count("*").alias("item_count"), *(F.count_if(is_(o)).alias(c) for c, (o, _, _) in zip(n, PHRASES, strict=True)))
    if outstanding is None:
        per = per.withColumn("outstanding", F.lit(None).cast("long"))
    else:
        other = outstanding.select(F.col("bucket").alias("ob"), F.col("outstanding").cast("long").alias("outstanding"))
        per = per.join(other, per["bucket"] == other["ob"], "left").drop("ob")
    total, left = F.col("item_count"), F.col("outstanding")
    said = [F.when(F.col(c) == 1, one).otherwise(many) for c, (_, many, one) in zip(n, PHRASES, strict=True)]
    clauses = F.array_compact(F.array(*(F.when(F.col(c) > 0, F.concat_ws(" ", _counted(F.col(c)), s)) for c, s in zip(n, said, strict=True))))
    sole = F.coalesce(*(F.when(F.col(c) == total, s) for c, s in zip(n, said, strict=True)))
    bad = reduce(lambda a, b: a + b, [F.col(c) for c, (o, _, _) in zip(n, PHRASES, strict=True) if o in ACTIONABLE])
    complete = F.col(n[[o for o, _, _ in PHRASES].index("COMPLETE")])
    verdict = F.when(bad > 0, F.concat(F.lit(ACTION), _counted(bad), F.lit(" of "), _counted(total), F.lit(BAD))).when(complete == total, ALL_FINE).otherwise(FINE)
    noun = F.concat(_counted(total), F.when(total == 1, " object").otherwise(" objects"))
    trail = F.when(left.isNull(), "").when(left == 0, NONE_LEFT).when(left == 1, ONE_LEFT).otherwise(F.concat(F.lit(" "), _counted(left), F.lit(MANY_LEFT)))
    body = F.when(sole.isNotNull(), F.concat(F.lit(" "), sole)).otherwise(F.concat(F.lit(" — "), F.array_join(clauses, "; ")))
    summary = F.concat(F.col("bucket"), F.lit(": "), noun, body, F.lit(". "), verdict, trail)
    tail = F.concat(F.lit(": "), noun, F.when(bad > 0, SUBJECT_BAD).otherwise(SUBJECT_FINE), F.when(left > 0, F.concat(F.lit(", "), _counted(left), F.lit(SUBJECT_LEFT))).otherwise(""))
    head = F.lit(SUBJECT)
    room = F.greatest(F.lit(SUBJECT_CHARS) - F.length(F.concat(head, F.lit("..."), tail)), F.lit(0))
    whole = F.concat(head, F.col("bucket"), tail)
    subject = F.when(F.length(whole) <= SUBJECT_CHARS, whole).otherwise(F.concat(head, F.substring(F.col("bucket"), F.lit(1), room), F.lit("..."), tail))
    return per.select("bucket", *within, "item_count", bad.alias("actionable"), summary.alias("summary"), subject.alias("subject"))


def metric_rows(buckets: DataFrame, disabled: Column) -> DataFrame:
    """Metric rows (bucket, metric, value) of a run.

    `buckets` has bucket, ops_read, matched, submitted, archived, errored. The three activity counters
    come together and only where one is not zero, archived only where not zero, errors always;
    the run's disabled buckets come once, without a bucket.
    """
    m = lambda name, value: F.struct(F.lit(name).alias("metric"), F.col(value).cast("double").alias("value"))
    active = (F.col("ops_read") != 0) | (F.col("matched") != 0) | (F.col("submitted") != 0)
    none = F.array().cast("array<struct<metric:string,value:double>>")
    rows = F.concat(
        F.when(active, F.array(m("TaggingOperationsRead", "ops_read"), m("MatchedObjects", "matched"), m("BatchJobsSubmitted", "submitted"))).otherwise(none),
        F.when(F.col("archived") != 0, F.array(m("ArchivedObjectsExcluded", "archived"))).otherwise(none),
        F.array(m("BucketErrors", "errored")),
    )
    per = buckets.select("bucket", F.inline(rows))
    whole = buckets.sparkSession.range(1).select(F.lit(None).cast("string").alias("bucket"), F.lit("DisabledBuckets").alias("metric"), disabled.cast("double").alias("value"))
    return per.unionByName(whole)


def overdue(jobs: DataFrame, reports: DataFrame, alerted: DataFrame, now: Column) -> DataFrame:
    """Jobs over for more than an hour whose report is neither there nor merged nor alerted yet.

    `jobs` has bucket, config_id, job_id, terminal_at, merged; `reports` job_id; `alerted` bucket and config_id.
    """
    late = jobs.where(~F.coalesce("merged", F.lit(False)) & (now > F.col("terminal_at") + F.make_dt_interval(secs=F.lit(float(OVERDUE_S)))))
    there = reports.select(F.col("job_id").alias("rj")).distinct()
    told = alerted.select(F.col("bucket").alias("ab"), F.col("config_id").alias("ac")).distinct()
    out = late.join(there, late["job_id"] == there["rj"], "left_anti")
    return out.join(told, (out["bucket"] == told["ab"]) & (out["config_id"] == told["ac"]), "left_anti")


def alert_due(last: Column, now: Column, least_s: int) -> Column:
    """An alert may go out: none was sent, or the last one is at least `least_s` old."""
    return F.coalesce(now >= last + F.make_dt_interval(secs=F.lit(float(least_s))), F.lit(True))


#: The shape of a report document that is declared in it, and the bytes that its groups may have.
FORMAT_VERSION, GROUP_BUDGET = 2, 240_000
GROUP = "struct<source_bucket:string,matched_rules:array<string>,destinations:array<string>,count:bigint,outcome_counts:map<string,bigint>,tagged_at_range:array<string>,last_modified_range:array<string>>"
DOCUMENT = f"summary string, format_version int, source_bucket string, item_count bigint, outstanding bigint, outcome_counts map<string,bigint>, groups array<{GROUP}>"


def _iso(ts: Column) -> Column:
    """ISO 8601 in UTC; a fraction is there only if it is not zero."""
    fraction = F.when(F.extract(F.lit("SECOND"), ts) % 1 == 0, "").otherwise(F.date_format(ts, ".SSSSSS"))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def _routed(items: DataFrame) -> DataFrame:
    """Rules and destinations as sorted sets, empty where nothing is known."""
    none = F.array().cast("array<string>")
    return items.withColumns({c: F.array_sort(F.array_distinct(F.coalesce(c, none))) for c in ("rules", "destinations")})


def report_groups(items: DataFrame, order: tuple[str, ...] = ("key", "version_id")) -> DataFrame:
    """Groups of a bucket's objects by rules and destinations (sets, whatever their order): `body` as in a document, `first`, `outcomes`.

    `items` has bucket, rules, destinations, outcome, tagged_at, last_modified and the columns `order`, whose smallest values tell where a
    group first appears. A range is left out where no object has such a time.
    """
    sets = _routed(items)
    keys = ["bucket", "rules", "destinations"]
    times = ("tagged_at", "last_modified")
    per = sets.groupBy(*keys, F.coalesce("outcome", F.lit("null")).alias("name")).agg(
        F.count("*").alias("n"), F.min(F.struct(*order)).alias("first"), *(f(t).alias(f"{a}_{t}") for t in times for a, f in (("lo", F.min), ("hi", F.max)))
    )
    named = F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n"))))  # one entry for each outcome
    whole = per.groupBy(*keys).agg(F.sum("n").alias("count"), named.alias("outcomes"), F.min("first").alias("first"), *(f(f"{a}_{t}").alias(f"{a}_{t}") for t in times for a, f in (("lo", F.min), ("hi", F.max))))
    span = lambda t: F.when(F.col(f"lo_{t}").isNotNull(), F.array(_iso(F.col(f"lo_{t}")), _iso(F.col(f"hi_{t}"))))
    body = F.struct(
        F.col("bucket").alias("source_bucket"), F.col("rules").alias("matched_rules"), "destinations", "count", F.col("outcomes").alias("outcome_counts"),
        *(span(t).alias(f"{t}_range") for t in times),
    )
    return whole.select(*keys, "first", body.alias("body"))


def completion_documents(items: DataFrame, outstanding: DataFrame | None = None, budget: int = GROUP_BUDGET, order: tuple[str, ...] = ("key", "version_id")) -> DataFrame:
    """Report documents: bucket, chunk, item_count, and `document` (JSON text), each with groups within the budget.

    Groups come in the order of their first object and are never cut; one that is larger than the budget is in a document of
    its own. A group is priced by its JSON text and a separator. `outstanding` as in `outcome_summary`.
    """
    groups = report_groups(items, order).withColumn("size", (F.octet_length(F.to_json("body")) + 2).cast("long"))
    placed = written(linked(groups, ["bucket"], ["first", "rules", "destinations"], "size", budget).withColumnRenamed("link", "chunk"))
    sets = _routed(items)
    where = placed.select(*(F.col(c).alias(f"_{c}") for c in ("bucket", "rules", "destinations")), "chunk")
    dealt = sets.join(where, (F.col("bucket") == F.col("_bucket")) & (F.col("rules") == F.col("_rules")) & (F.col("destinations") == F.col("_destinations")))
    said = outcome_summary(dealt, outstanding, ("chunk",)).select(F.col("bucket").alias("sb"), F.col("chunk").alias("sc"), "summary", "item_count")
    counts = placed.select("bucket", "chunk", F.explode("body.outcome_counts").alias("name", "n")).groupBy("bucket", "chunk", "name").agg(F.sum("n").alias("n"))
    counts = counts.groupBy(F.col("bucket").alias("cb"), F.col("chunk").alias("cc")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n")))).alias("outcome_counts"))
    # a chunk's groups are within the budget, or one group
    by_place = F.array_sort(F.collect_list(F.struct("pos", "body")), lambda x, y: F.when(x["pos"] < y["pos"], -1).otherwise(1))
    lists = placed.groupBy("bucket", "chunk").agg(F.transform(by_place, lambda g: g["body"]).alias("groups"))
    joined = lists.join(said, (F.col("bucket") == F.col("sb")) & (F.col("chunk") == F.col("sc"))).join(counts, (F.col("bucket") == F.col("cb")) & (F.col("chunk") == F.col("cc")))
    if outstanding is None:
        joined = joined.withColumn("outstanding", F.lit(None).cast("long"))
    else:
        left = outstanding.select(F.col("bucket").alias("ob"), F.col("outstanding").cast("long").alias("outstanding"))
        joined = joined.join(left, F.col("bucket") == F.col("ob"), "left")
    document = F.to_json(F.struct("summary", F.lit(FORMAT_VERSION).alias("format_version"), F.col("bucket").alias("source_bucket"), "item_count", "outstanding", "outcome_counts", "groups"))
    return joined.select("bucket", "chunk", "item_count", document.alias("document"))
