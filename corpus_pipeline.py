"""Corpus preparation: toxicity, SimHash near-dedup, suffix-array dedup, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagflow.llm import packing, simhash, suffixes, toxicity
from tagflow.llm.common import removed, shared_checkpoints, table
from tagflow.session import ship

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Some stage (toxicity, packing) is beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


# Every stage handles nulls in any column, empty and very long texts, equal rows, empty tables and extra
# columns of any name; its docstring says what becomes of them.


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that operator 9 does not predict toxic; it learns from the whole tables' labels.

    Null and empty texts get the model's base score, which is below the threshold, and stay, as do rows with a null doc_id;
    equal rows are judged alike; an empty table stays empty; other columns are as they were. A very long text is
    judged whole.
    """
    ship(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8): the one with the smallest doc_id.

    All texts without words (null, empty) are one group; rows with a null doc_id stay, and so do equal rows of a kept
    doc_id; an empty table stays empty; other columns are as they were. A very long text is compared whole.
    """
    ship(spark)
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes that a smaller document holds too.

    Rows stay, also those left with an empty text; a null text stays null; a null doc_id neither loses bytes nor makes others
    lose any; equal rows are no repeats of each other; an empty table stays empty; `n_chars` is counted anew, other
    columns are as they were. A very long text is searched whole.
    """
    ship(spark)
    return suffixes.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts in sequences of 1024 ids (operator 7's columns).

    A null or empty text is the end id alone; equal rows are packed each; a null doc_id stays null; an empty table gives no
    rows; other columns are dropped. A very long text is cut into full windows first.
    """
    ship(spark)
    return packing.pack(docs, TOKENIZER)


STAGES = [("toxicity", drop_toxic), ("simhash_dedup", drop_near_copies), ("suffix_dedup", cut_repeats), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each result is written to the shared folder and read again.

    What a stage read goes once its own result is there: the folder holds two stages at most.
    """
    shared_checkpoints(spark)
    sc = spark.sparkContext
    docs = table(spark, sf_dir, "documents")
    folder = f"{sc.getCheckpointDir()}/pipeline-{sc._jvm.java.util.UUID.randomUUID()}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if k:
            removed(spark, f"{folder}/{k - 1}-{STAGES[k - 1][0]}")
    return docs
