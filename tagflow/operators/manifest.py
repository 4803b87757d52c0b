"""Manifests: union of matches, first version, deletes, rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.functions.columns import bucket_of_arn, manifest_row


def union(matches: DataFrame) -> DataFrame:
    """One row for each object: the version that was seen first, and all rules and destinations."""
    arn = F.when(F.col("destination_arn") != "", bucket_of_arn(F.col("destination_arn")))
    order = F.struct("first_seen", "lid")
    return matches.groupBy("bucket", "key").agg(
        F.min_by(F.struct("version_id", F.col("record_timestamp").alias("tagged_at")), order).alias("first"),
        F.array_sort(F.collect_set("rule_id")).alias("rules"),
        F.array_sort(F.collect_set(arn)).alias("destinations"),
    ).select("bucket", "key", "first.version_id", "first.tagged_at", "rules", "destinations")


def without_deleted(manifest: DataFrame, deletes: DataFrame) -> DataFrame:
    """Null-safe anti join: (key, null) and (key, v1) are different versions."""
    d = deletes.select(F.col("bucket").alias("db"), F.col("key").alias("dk"), F.col("version_id").alias("dv"))
    return manifest.join(d, (manifest["bucket"] == d["db"]) & (manifest["key"] == d["dk"]) & manifest["version_id"].eqNullSafe(d["dv"]), "left_anti")


def rendered(manifest: DataFrame) -> DataFrame:
    return manifest.select("bucket", manifest_row(F.col("bucket"), F.col("key"), F.col("version_id")).alias("row"))


def checksums(manifest: DataFrame) -> DataFrame:
    """Per bucket: object_count, and a checksum over the sums of 4096 parts (by a hash of the key), each over its rows in order.

    No bucket is gathered in one place: a part holds the 4096th of it.
    """
    part = F.substring(F.md5("key"), 1, 3)
    row = F.struct("key", manifest_row(F.col("bucket"), F.col("key"), F.col("version_id")).alias("row"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["row"]), "\n")
    per = manifest.groupBy("bucket", part.alias("part")).agg(F.count("*").alias("n"), F.md5(text).alias("sum"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "sum"))), lambda x: x["sum"]), "")
    return per.groupBy("bucket").agg(F.sum("n").alias("object_count"), F.md5(whole).alias("checksum"))


def references(ops: DataFrame, kept: DataFrame) -> DataFrame:
    """Every operation on a kept (bucket, key, version), whether it matched or not."""
    k = kept.select(F.col("bucket").alias("kb"), F.col("key").alias("kk"), F.col("version_id").alias("kv")).distinct()
    return ops.join(k, (ops["bucket"] == k["kb"]) & (ops["key"] == k["kk"]) & ops["version_id"].eqNullSafe(k["kv"]), "left_semi")
