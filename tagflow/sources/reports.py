"""Completion reports: headerless CSV files below a job's folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.functions.columns import decode_key, status_and_error
from tagflow.sources.journal import ABSENT

RAW = "bucket string, key string, version_id string, task_status string, c4 string, c5 string, result_message string"
ROWS = "bucket string, key string, version_id string, task_status string, http_status string, error_code string, result_message string"


def parsed(raw: DataFrame) -> DataFrame:
    """Rows as files have them, parsed: keys decoded, the two transposable columns by their content, empty texts null.

    The literal version `null` is the null version. Other columns of `raw` stay.
    """
    status, code = status_and_error(F.col("c4"), F.col("c5"))
    blank = lambda c: F.when(F.col(c) != "", F.col(c)).alias(c)
    version = F.when(~F.col("version_id").isin("null", ""), F.col("version_id"))
    more = [c for c in raw.columns if c not in {x.split(" ")[0] for x in RAW.split(", ")}]
    return raw.select("bucket", F.coalesce(decode_key(F.col("key")), F.lit("")).alias("key"), version.alias("version_id"), blank("task_status"), status.alias("http_status"), code.alias("error_code"), blank("result_message"), *more)


def read_reports(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all result files below `folder`, with `file`; side files are not read, no folder gives no rows.

    Short rows have nulls at the end, keys may hold commas, quotes and line ends in quotes.
    """
    reader = spark.read.schema(RAW).option("escape", '"').option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    try:
        raw = reader.csv(folder).withColumn("file", F.col("_metadata.file_path"))
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return spark.createDataFrame([], f"{ROWS}, file string")
        raise
    return parsed(raw.where(F.col("file").contains("/results/")))


def report_exists(spark: SparkSession, folder: str) -> bool:
    """Something is there below `folder`."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(path) and fs.listFiles(path, True).hasNext())
