"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagflow.llm import bpe, ctw, embed_dedup, knn, licenses, oracles, packing, phrases, simhash, subtrees, suffixes, toxicity, trie, urls
from tagflow.llm.common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_digest(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_scores(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subtrees.removal_digest(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_license_scan, op2_url_filter, op3_simhash, op4_suffix_dedup, op5_lm_score, op6_embedding_dedup, op7_packing, op8_topk_search, op9_toxicity, op10_bpe, op11_phrases, op12_substring_dedup, op13_prefix_trie, pipeline]
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL expresses over whole tables."""
    return {"op8_topk_search": oracles.TOP_SCORES, "op11_phrases": oracles.PHRASES, "op12_substring_dedup": oracles.SUBTREES, "op13_prefix_trie": oracles.TRIE}
