"""The pipeline's stages against plain results, row by row."""

import corpus_pipeline
from tagflow.llm import toxicity
from tests.llm.test_near_dedup import corpus, kept_by_brute_force


def test_toxicity_stage_keeps_what_is_not_predicted_toxic(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    want = sorted(r.doc_id for r in toxicity.score(docs, labels).where("predicted = 0").collect())
    assert sorted(r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, sf).collect()) == want and 0 < len(want) < docs.count()


def test_near_dedup_stage_keeps_the_documents_of_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    odd = [(10**6 + i, t) for i, t in corpus()]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    kept = corpus_pipeline.drop_near_copies(spark, both, sf)
    assert sorted(r.doc_id for r in kept.collect()) == kept_by_brute_force(rows + odd)
