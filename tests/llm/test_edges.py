"""Nulls beside large ids, repeated rows, empty and very long texts, empty tables and clashing names, for every operator."""

import hashlib

import numpy as np
import public_tokenizers
import pytest

from tagflow.llm import bpe, common, ctw, embed_dedup, knn, licenses, packing, simhash, suffixes, toxicity, urls

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
BIG = 2**53 + 1
SENTENCE = "the river runs past the old mill and the long wall before it meets the sea again. "
ROWS = [(BIG, "one two three four five six seven"), (None, "no id here"), (BIG + 2, None), (BIG + 4, ""), (BIG + 4, ""), (None, None), (5, SENTENCE * 2), (5, SENTENCE * 2)]
# names that the operators use inside, an id that must stay a long beside a null, and a column with a dot and a blank
SCHEMA = "doc_id long, text string, score double, __score long, grp long, fp string, mark int, `a. b` long, n_chars int"


def docs(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, 0.5, BIG if k % 2 else None, 3, "f", 4, BIG + 6, 5) for k, (i, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality", "toxic")


def queries(labels):
    return {
        "op1": licenses.scan,
        "op3": simhash.near_duplicates,
        "op4": suffixes.removal_digest,
        "op5": ctw.score,
        "op7": lambda d: packing.pack(d, TOKENIZER),
        "op9": lambda d: toxicity.score(d, labels),
        "op10": lambda d: bpe.digests(d, TOKENIZER),
    }


@pytest.mark.parametrize("name", ["op1", "op3", "op4", "op5", "op7", "op9", "op10"])
def test_ids_and_repeats_stay_as_they_are(spark, labels, name):
    run = queries(labels)[name]
    got = [r.doc_id for r in run(docs(spark).coalesce(1)).collect()]
    assert sorted(got, key=str) == sorted((i for i, _ in ROWS), key=str)
    assert run(docs(spark, [])).count() == 0


def test_page_ids_stay_as_they_are(spark):
    rows = [(BIG, "http://a.example.com/x"), (None, None), (BIG, "http://a.example.com/x"), (BIG + 2, "http://" + "a" * 200_000 + ".net/"), (7, "://")]
    pages = spark.createDataFrame([(i, u, "h", 1.0) for i, u in rows], "page_id long, url string, path string, score double").coalesce(1)
    got = {(r.page_id, len(r.host)): (r.path, r.rule, r.verdict) for r in urls.judge(pages).collect()}
    assert sorted(got, key=str) == sorted({(BIG, 13), (None, 0), (BIG + 2, 200_004), (7, 0)}, key=str)
    assert got[BIG + 2, 200_004] == ("/", "net/", "block") and urls.judge(pages).count() == 5


def stages(spark, labels):
    import corpus_pipeline as P

    named = dict(P.STAGES)
    sf = "/root/testdata/sf0.001"
    return [lambda d, f=named[s]: f(spark, d, sf) for s in ("toxicity", "simhash_dedup", "suffix_dedup")]


def test_stages_keep_ids_columns_and_values(spark, labels):
    table = docs(spark).coalesce(1)
    for stage in stages(spark, labels):
        out = stage(table)
        assert out.columns == table.columns
        rows = out.collect()
        assert {r.doc_id for r in rows} >= {BIG, None, 5} and {r["a. b"] for r in rows} == {BIG + 6} and {r["__score"] for r in rows} <= {BIG, None}
        assert stage(table.where("false")).count() == 0
    texts = sorted((r.text for r in stages(spark, labels)[2](table).collect()), key=str)
    assert texts == sorted((t for _, t in ROWS), key=str)


def test_near_copies_of_empty_texts_are_one_group(spark, labels):
    kept = stages(spark, labels)[1](docs(spark)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(map(str, [BIG, BIG + 2, None, None, 5, 5]))


def test_pipeline_run_on_empty_and_null_tables(spark, tmp_path):
    import corpus_pipeline as P

    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    source.where("false").write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
    source.limit(3).selectExpr("doc_id", "cast(null as string) text", "lang", "source", "n_chars").write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    out = P.run(spark, str(tmp_path)).collect()
    assert [(r.length, r.doc_tokens) for r in out] == [(1, 1)]


def test_a_very_long_text(spark, labels):
    """10 MB in one row: results of the short operators by hand, the others by their sums."""
    words = np.random.default_rng(0).integers(0, 5000, 1_500_000)
    text = " ".join(f"w{k}" for k in words.tolist()) + " MIT License " + "x" * 1_000_000
    table = docs(spark, [(1, text), (2, text[:200_000]), (3, "w1 w2")])
    size = {i: len(t) for i, t in ((1, text), (2, text[:200_000]), (3, "w1 w2"))}
    found = {r.doc_id: r for r in licenses.scan(table).collect()}
    assert (found[1].n_words, found[1].base_labels, found[2].n_base) == (1_500_003, "mit", 0)
    cut = {r.doc_id: r for r in suffixes.removal_digest(table).collect()}
    assert [(cut[i].n_bytes, cut[i].n_removed) for i in (1, 2, 3)] == [(size[1], 0), (size[2], size[2]), (5, 0)]
    assert {r.doc_id: r.n_tokens for r in ctw.score(table).collect()}[1] == 1_500_004
    tokens = {r.doc_id: r for r in bpe.digests(table, TOKENIZER).collect()}
    assert tokens[1].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    packed = packing.pack(table, TOKENIZER).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in packed} == {i: tokens[i].n_tokens + 1 for i in (1, 2, 3)}
    assert simhash.near_duplicates(table).count() == toxicity.score(table, labels).count() == 3


def test_a_table_of_empty_texts_is_cut_into_groups(spark, monkeypatch):
    table = spark.range(3000).selectExpr("id as doc_id", "cast(null as string) as text")
    packed = packing.pack(table, TOKENIZER, group_bytes=common.ROW_BYTES * 300).collect()
    assert len({r.sequence_id >> 32 for r in packed}) == 10 and sum(r.length for r in packed) == 3000
    monkeypatch.setattr(ctw, "GROUP_BYTES", common.ROW_BYTES * 100)
    assert {(r.n_tokens, r.score) for r in ctw.score(table).collect()} == {(1, 0.0)}


def test_scores_do_not_depend_on_groups_and_salts(spark, monkeypatch):
    """Small groups in several salts give the scores of few large groups in one."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = {r.doc_id: r for r in ctw.score(table).collect()}
    monkeypatch.setattr(ctw, "GROUP_BYTES", 4000)
    monkeypatch.setattr(ctw, "MERGED_GROUPS", 8)
    for r in ctw.score(table).collect():
        w = whole[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (w.n_tokens, w.n_known, w.train_tokens)
        assert r.score == pytest.approx(w.score, rel=1e-5) and r.base_score == pytest.approx(w.base_score)


def test_crowded_segments_are_linked_by_the_ball_over_the_other_bits(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HEAVY", 4)
    rng = np.random.default_rng(9)
    fp = []
    for base in rng.integers(0, 1 << 63, 6, dtype=np.uint64).tolist():
        fp += [base] + [base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (30, 2))]
        fp += [base ^ ((1 << 40) - (1 << 32)) ^ (1 << int(a)) for a in rng.integers(0, 64, 20)]
    fp = sorted(set(fp))
    classes = spark.createDataFrame([(k, int(np.uint64(x).astype(np.int64))) for k, x in enumerate(fp)], "v long, fp long")
    found = common.connected_components(simhash.links(classes, 1, 2, 4, 2)).collect()
    root = np.arange(len(fp))
    i, j = np.nonzero(np.triu(np.bitwise_count(np.array(fp, np.uint64)[:, None] ^ np.array(fp, np.uint64)[None, :]) <= 2, 1))
    root = simhash._hook(root, i, j)
    assert simhash.heavy_values(classes, 2).count() > 4
    assert {r.id: r.component_id for r in found} == {k: int(root[k]) for k in range(len(fp)) if (root == root[k]).sum() > 1}


def test_components_of_a_star_and_a_chain_with_salts(spark, monkeypatch):
    monkeypatch.setattr(common, "SALT_ROWS", 50)
    edges = [(1, k) for k in range(100, 400)] + [(k, k + 1) for k in range(1000, 1030)] + [(5, 5), (None, 3), (2000, 100)]
    got = {r.id: r.component_id for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 1 for k in [1, 2000, *range(100, 400)]} | {k: 1000 for k in range(1000, 1031)}


def test_wider_segments_meet_as_often(spark, monkeypatch):
    """Codes as for many more documents: the same documents stay."""
    rng = np.random.default_rng(12)
    rows = []
    for k in range(40):
        base = [f"w{x}" for x in rng.integers(0, 3000, 300)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:285] + ["new"] * 15 if k % 2 else base[:200]))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    plain = sorted(r.doc_id for r in simhash.keep_one(table).collect())
    monkeypatch.setattr(simhash, "SEGMENT_ROWS", 80 / 2**19)
    assert simhash.code_shape(80, 0.8) == (19, 25, 8)
    assert sorted(r.doc_id for r in simhash.keep_one(table).collect()) == plain == sorted([*range(0, 80, 2), *range(1, 80, 4)])


@pytest.mark.parametrize("block", [8, 8192])
def test_embedding_links_by_codes_and_by_exact_pairs(spark, monkeypatch, block):
    """Clusters around the threshold: what the bytes leave open is recomputed; recall and precision against brute force."""
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((40, 64))
    x = np.repeat(centre, 12, axis=0) + rng.standard_normal((480, 64)) * rng.choice([0.1, 0.3, 0.33, 0.36], (480, 1))
    x = np.concatenate((x, rng.standard_normal((300, 64)), x[:5])).astype(np.float32).astype(float)
    rows = [(BIG + k, v.tolist(), 1) for k, v in enumerate(x)] + [(None, x[0].tolist(), 1), (4, None, 1)]
    got = {r.vec_id: r for r in embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, keys int")).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    want = near.sum(1) - 1
    links = np.array([got[BIG + k].n_links for k in range(len(x))])
    assert (links <= want).all() and links.sum() >= 0.97 * want.sum() and want.sum() > 500
    assert got[4].kept and got[None].component_id is None
    assert len(got) == len(x) + 2


def test_scores_of_vectors_with_large_ids(spark):
    rows = [(20 * BIG, [1.0, 0.5]), (BIG, [1.0, 0.25]), (None, [9.0, 9.0]), (BIG + 1, [0.5, 0.5])]
    got = sorted(tuple(r) for r in knn.top_scores(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(20 * BIG, 1, BIG, 64 * 64 + 32 * 16), (20 * BIG, 2, BIG + 1, 64 * 32 + 32 * 32)]
