"""Journal sources: any Spark format with the journal's schema, and one made from an events table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ABSENT = {"TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND", "PATH_NOT_FOUND"}
SCHEMA = """bucket string, key string, version_id string, record_type string, object_tags map<string,string>, sequence_number string,
record_timestamp timestamp_ntz, last_modified_date timestamp_ntz, storage_class string, is_delete_marker boolean"""


def read_journal(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame | None:
    """The journal, or None where it is not there (yet)."""
    try:
        return spark.read.format(kind).schema(SCHEMA).load(path)
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return None
        raise


def from_events(events: DataFrame) -> DataFrame:
    """A journal by fixed formulas over an events table, with duplicate deliveries."""
    e, k = F.col("event_id"), F.get_json_object("props", "$.k")
    base = events.select(
        "event_id",
        F.concat(F.lit("lake-"), (F.col("user_id") % 3).cast("string")).alias("bucket"),
        F.concat(F.lit("u/"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_type")).alias("key"),
        F.when(e % 5 != 0, F.concat(F.lit("v"), (e % 3).cast("string"))).alias("version_id"),
        F.when(e % 10 == 9, "DELETE").when(e % 10 == 8, "PUT").otherwise("UPDATE_METADATA").alias("record_type"),
        F.create_map(F.lit("type"), F.col("event_type"), F.lit("k"), k).alias("object_tags"),
        F.lpad(e.cast("string"), 12, "0").alias("sequence_number"),
        F.col("ts").alias("record_timestamp"),
        F.when((F.col("event_type") == "error") & (e % 2 == 0), "GLACIER").when(e % 11 == 0, F.lit(None)).otherwise("STANDARD").alias("storage_class"),
        (e % 20 == 9).alias("is_delete_marker"),
    )
    again = base.where((e % 7 == 0) & (e % 10 < 8)).withColumns(
        {
            "record_type": F.lit("UPDATE_METADATA"),
            "sequence_number": F.lpad((e + 500000).cast("string"), 12, "0"),
            "storage_class": F.when(e % 14 == 0, "DEEP_ARCHIVE").otherwise("STANDARD"),
        }
    )
    return base.unionByName(again).drop("event_id")
