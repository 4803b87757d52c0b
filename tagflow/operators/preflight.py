"""Counts of distinct keys before a run, from sketches that are made once and united for any period of whole hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.operators import rules as R
from tagflow.sources.scratch import written

#: Size of a sketch (the logarithm of its registers); a united one has a relative standard error of 1.04 / 2 ** (LG_K / 2).
LG_K = 12
#: Standard errors that an estimate is trusted to: nearer to a limit than that, keys are counted.
ERRORS = 6
MARGIN = ERRORS * 1.04 / 2 ** (LG_K / 2)


def _hour(at: Column) -> Column:
    return F.date_trunc("hour", at.cast("timestamp"))


def sketched(ops: DataFrame) -> DataFrame:
    """Bucket, hour and a sketch of the hour's keys; rows without a key or a time are not counted."""
    rows = ops.where(F.col("key").isNotNull() & F.col("record_timestamp").isNotNull())
    return rows.groupBy("bucket", _hour(F.col("record_timestamp")).alias("hour")).agg(F.hll_sketch_agg("key", F.lit(LG_K)).alias("sketch"))


def estimated(sketches: DataFrame, period: Column) -> DataFrame:
    """Bucket, `period` (of the column hour) and the estimate of its distinct keys, from the hours' sketches alone."""
    return sketches.groupBy("bucket", period.alias("period")).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def over_limit(ops: DataFrame, limit: int, period: str = "day") -> DataFrame:
    """Bucket, period, estimate, `exact` (where the estimate is too near to the limit to tell) and over_limit.

    Only rows of periods near the limit are read a second time and counted; elsewhere the error bound decides.
    """
    whole = lambda at: F.date_trunc(period, at.cast("timestamp"))
    per = written(estimated(sketched(ops), whole(F.col("hour"))))
    near = per.where(F.col("estimate").between(limit * (1 - MARGIN), limit * (1 + MARGIN))).select(F.col("bucket").alias("nb"), F.col("period").alias("np"))
    rows = ops.where(F.col("key").isNotNull()).select("bucket", whole(F.col("record_timestamp")).alias("period"), "key")
    again = rows.join(near, rows["bucket"].eqNullSafe(near["nb"]) & (rows["period"] == near["np"]), "left_semi")
    exact = again.groupBy(F.col("bucket").alias("eb"), F.col("period").alias("ep")).agg(F.count_distinct("key").alias("exact"))
    told = per.join(exact, per["bucket"].eqNullSafe(exact["eb"]) & (per["period"] == exact["ep"]), "left").drop("eb", "ep")
    return told.withColumn("over_limit", F.coalesce("exact", "estimate") > limit)


def matched_keys(ops: DataFrame, rules: DataFrame) -> DataFrame:
    """Bucket and `matches`: the exact number of distinct keys of a window that some rule matches, before any deduplication."""
    return R.match(ops.withColumn("lid", F.col("key")), rules).groupBy("bucket").agg(F.count_distinct("key").alias("matches"))
