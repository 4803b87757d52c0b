"""The window of processed ids in generations: a run writes its own rows, by day, and a list says which folders hold.

The list is part of the stored state, so rows and marks change together. Generations are merged as their sizes double: each row
is written again a number of times that grows with the logarithm of the rows. Days before every bucket's window leave the list.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a day that one file holds, about.
FILE_ROWS = 1 << 20
SCHEMA = "bucket string, lid string, watermark timestamp_ntz"


def _folders(held: dict, generations: list[dict]) -> list[str]:
    return [f"{held['root']}/gen={g['gen']}/try={g['try']}/day={d}" for g in generations for d in g["days"]]


def _rows(spark: SparkSession, held: dict, generations: list[dict]) -> DataFrame:
    """Rows of some generations, without those that a later one made void."""
    folders = _folders(held, generations)
    if not folders:
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(f"{SCHEMA}, gen long, try string, day string").option("basePath", held["root"]).parquet(*folders)
    oldest = min(g["gen"] for g in generations)
    cuts = [(c["bucket"], c["gen"], datetime.fromisoformat(c["after"])) for c in held["cuts"] if c["gen"] > oldest]
    if cuts:  # one for each mark that was set back while older generations stand
        cut = spark.createDataFrame(cuts, "cb string, cg long, after timestamp_ntz")
        rows = rows.join(F.broadcast(cut), (F.col("bucket") == F.col("cb")) & (F.col("gen") < F.col("cg")) & (F.col("watermark") > F.col("after")), "left_anti")
    return rows.select("bucket", "lid", "watermark")


def read(spark: SparkSession, window: dict | str | None) -> DataFrame:
    """Bucket, lid and watermark of the window; an id that was processed again has a row for each time. A text is the folder of a whole window."""
    if isinstance(window, str):
        return spark.read.schema(SCHEMA).parquet(window)
    return spark.createDataFrame([], SCHEMA) if window is None else _rows(spark, window, window["generations"])


def append(spark: SparkSession, window: dict | str | None, root: str, rows: DataFrame, size: int, set_back: dict[str, datetime], keep_after: date | None) -> dict:
    """The list after a run that processed `rows` (bucket, lid, watermark; about `size` of them).

    Of a bucket in `set_back` the rows after its mark there, in all earlier generations, are void. Days before
    `keep_after` leave the list (None: none does). Nothing that the old list names is changed.
    """
    held = window if isinstance(window, dict) else {"root": root, "next": 0, "generations": [], "cuts": []}
    number = held["next"]
    cuts = held["cuts"] + [{"bucket": b, "gen": number, "after": at.isoformat()} for b, at in set_back.items()]
    left = [g | {"days": [d for d in g["days"] if keep_after is None or d >= keep_after.isoformat()]} for g in held["generations"]]
    left = [g for g in left if g["days"]]
    merged, total = [], size
    while left and left[-1]["rows"] < 2 * total:
        total += left[-1]["rows"]
        merged.append(left.pop())
    fresh = rows.select("bucket", "lid", "watermark")
    if isinstance(window, str):
        old = read(spark, window)
        for bucket, at in set_back.items():
            old = old.where((F.col("bucket") != bucket) | (F.col("watermark") <= F.lit(at.isoformat(" ")).cast("timestamp_ntz")))
        fresh = fresh.unionByName(old)
    if merged:
        fresh = fresh.unionByName(_rows(spark, held | {"cuts": cuts}, merged))
        fresh = fresh.groupBy("bucket", "lid").agg(F.max("watermark").alias("watermark"))
    made = {"gen": number, "try": uuid.uuid4().hex}
    folder = f"{held['root']}/gen={number}/try={made['try']}"
    day = F.date_format("watermark", "yyyy-MM-dd")
    # a day is split by id, so a busy day is not one task
    fresh.withColumn("day", day).repartition("day", F.pmod(F.xxhash64("lid"), F.lit(total // FILE_ROWS + 1))).write.partitionBy("day").parquet(folder)
    counts = spark.read.parquet(folder).groupBy(F.col("day").cast("string").alias("day")).count().collect() if total else []  # one row a day
    made |= {"rows": sum(r["count"] for r in counts), "days": sorted(r.day for r in counts)}
    generations = [*left, made] if counts else left
    oldest = min((g["gen"] for g in generations), default=number)
    return {"root": held["root"], "next": number + 1, "generations": generations, "cuts": [c for c in cuts if c["gen"] > oldest]}


def folders(window: dict | str | None) -> list[str]:
    """Folders that the list names: what retention must leave alone."""
    if window is None or isinstance(window, str):
        return [window] if window else []
    return [f"{window['root']}/gen={g['gen']}/try={g['try']}" for g in window["generations"]]
