"""Operators 6 and 8 on vectors of several lengths, and exact scores."""

import numpy as np
import pytest

from tagflow.llm import embed_dedup, knn


def test_vectors_of_a_rarer_length_link_too(spark):
    rng = np.random.default_rng(8)
    rows = []
    for size, many in ((16, 40), (8, 10), (24, 1)):
        for v in rng.standard_normal((many, size)):
            rows += [(len(rows), v.tolist()), (len(rows) + 1, v.tolist()), (len(rows) + 2, (v + 0.001).tolist())]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_vectors(docs).collect()}
    unit = [np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) for _, v in rows]
    near = [{j for j in range(len(rows)) if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9} for i in range(len(rows))]
    assert all(got[i][0] == len(near[i]) - 1 for i in range(len(rows)))
    assert all(got[i][2] == (got[i][1] == i) and got[j][1] == got[i][1] for i in range(len(rows)) for j in near[i])


def brute(rows, k=20, every=20):
    """Python integers, so nothing is rounded."""
    whole = [(i, [int(np.floor(64 * np.float64(x))) for x in v]) for i, v in rows]
    out = []
    for q, a in whole:
        if q % every == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q and len(b) == len(a))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def found(spark, rows):
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in knn.top_scores(docs).collect())


def test_queries_of_every_length_are_answered(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal((3, 2, 5)[i % 3]).tolist()) for i in range(130)] + [(200, [1.0]), (220, [1.0, 2.0, 3.0, 4.0])]
    got = found(spark, rows)
    assert got == brute(rows)
    assert {q for q, *_ in got} == {0, 20, 40, 60, 80, 100, 120}


@pytest.mark.parametrize("scale", [1e4, 1e6])
def test_large_components_are_scored_exactly(spark, scale):
    rng = np.random.default_rng(10)
    rows = [(i, (np.round(rng.standard_normal(6) * 3) * scale + rng.integers(0, 3, 6) / 64).tolist()) for i in range(150)]
    assert found(spark, rows) == brute(rows)


def test_two_scores_of_one_rounded_value_keep_their_order(spark):
    big = 2.0**31 / 64
    rows = [(20, [big, 1 / 64]), (1, [big, 1 / 64]), (2, [big, 2 / 64]), (3, [big, 3 / 64])]
    assert found(spark, rows)[:3] == [(20, 1, 3, 2**62 + 3), (20, 2, 2, 2**62 + 2), (20, 3, 1, 2**62 + 1)]


def test_a_score_beyond_a_long_is_an_error(spark):
    with pytest.raises(Exception, match="beyond a long"):
        found(spark, [(20, [1e9, 1e9]), (1, [1e9, 1e9])])
