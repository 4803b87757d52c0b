"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table by the path that Spark resolves."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_checkpoints(spark: SparkSession) -> None:
    """Use the cluster's checkpoint folder; a local one is made only by a local session that names none (tests)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint."""
    shared_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written to the shared folder, whose size the planner then knows (rows of small values)."""
    spark = df.sparkSession
    shared_checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system that is no longer read."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished work that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: What a row costs beside its text, in bytes of text: tables of empty texts are cut into groups too.
ROW_BYTES = 128


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts and ROW_BYTES for each row; one scan with a partial sum, used to size buckets in proportion."""
    row = docs.agg(F.sum(F.octet_length("text")).alias("n"), F.count("*").alias("rows")).first()
    return int(row["n"] or 0) + ROW_BYTES * int(row["rows"])


def id_text(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """`df` with an id as text for a Python stage: pandas would make doubles of longs that stand beside a null."""
    return df.withColumn(name, F.col(name).cast("long").cast("string"))


def id_long(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """The id of `id_text` as a long again."""
    return df.withColumn(name, F.col(name).cast("long"))


def parts(total: int, each: int, least: int = 1) -> int:
    """How many buckets of about `each` units hold `total` units."""
    return max(least, -(-total // each))


def units(batches: Iterator[pd.DataFrame], max_bytes: int = 12 << 20) -> Iterator[pd.DataFrame]:
    """Regroup Arrow batches into frames of a bounded number of text bytes (a longer text is alone)."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        if not len(batch):
            continue
        text = batch["text"]
        lengths = np.fromiter((len(x) if isinstance(x, str) else 0 for x in text), dtype=np.int64, count=len(batch))
        start = 0
        for k, n in enumerate(lengths):
            if size and size + n > max_bytes:
                held.append(batch.iloc[start:k])
                yield pd.concat(held, ignore_index=True)
                held, size, start = [], 0, k
            size += int(n)
        held.append(batch.iloc[start:])
    if held and sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def runs(keys: np.ndarray) -> np.ndarray:
    """Start offsets of the runs of equal values in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))


#: Rows that one salt of a hot key stands for in the look-ups of `connected_components`.
SALT_ROWS = 256


def looked_up(rows: DataFrame, key: str, other: str, table: DataFrame, salts: int) -> DataFrame:
    """`rows` with `up`, what `table` (k, up; k unique) holds for the column `key` (null where nothing).

    The rows of a hot key are dealt by the column `other` to salts, and the table answers each
    (key, salt) that is there once: no task gets all rows of a key.
    """
    table = table.select(F.col("k").alias("_k"), "up")
    if salts == 1:
        return rows.join(table, rows[key] == table["_k"], "left").drop("_k")
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(other), F.lit(salts)))
    asked = dealt.select(F.col(key).alias("_key"), F.col("_salt").alias("_at")).distinct()
    told = asked.join(table, asked["_key"] == table["_k"]).select("_key", "_at", "up")
    return dealt.join(told, (dealt[key] == told["_key"]) & (dealt["_salt"] == told["_at"]), "left").drop("_key", "_at", "_salt")


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id for every id that has an edge: columns id, component_id.

    `edges` has columns a, b. Each round hooks every vertex to its smallest neighbour (a
    partial `min`), shortens the chains by joins and contracts the edges, so the number of
    rounds is logarithmic and no vertex's neighbours are ever gathered in one place; a root that many
    vertices share is looked up by salts. Null ends and loops are dropped. Empty edges give an empty result.
    """
    spark = edges.sparkSession
    both = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = written(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = None
    while left := both.count():
        salts = parts(left, SALT_ROWS)
        parent = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p"))
        for _ in range(2):
            up = parent.select(F.col("a").alias("k"), F.col("p").alias("up"))
            parent = looked_up(parent, "p", "a", up, salts).select("a", F.coalesce("up", "p").alias("p"))
        parent = written(parent)
        up = parent.select(F.col("a").alias("k"), F.col("p").alias("up"))
        if labels is None:
            labels = parent.select(F.col("a").alias("id"), F.col("p").alias("component_id"))
        else:
            labels = written(looked_up(labels, "component_id", "id", up, salts).select("id", F.coalesce("up", "component_id").alias("component_id")))
        half = looked_up(both, "a", "b", up, salts).select(F.col("up").alias("pa"), "b")
        both = written(looked_up(half, "b", "pa", up, salts).where("pa <> up").select(F.col("pa").alias("a"), F.col("up").alias("b")).distinct())
    if labels is None:
        kind = dict(edges.dtypes)["a"]
        return spark.createDataFrame([], f"id {kind}, component_id {kind}")
    return labels
