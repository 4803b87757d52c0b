"""Operator 8 against brute force: repeated ids and rows, ties, and many cells and groups."""

from collections import Counter

import numpy as np
import pytest

from tagflow.llm import knn

SCHEMA = "vec_id long, embedding array<float>, cell int, n int, ask long"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v], 1, 2, 3) for i, v in rows], SCHEMA)


def brute(rows, k=20):
    ids = np.array([i for i, _ in rows])
    whole = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float))
    out = Counter()
    for at in np.flatnonzero(ids % 20 == 0):
        score = (whole @ whole[at]).astype(np.int64)
        other = np.flatnonzero(ids != ids[at])
        order = other[np.lexsort((ids[other], -score[other]))][:k]
        out.update((int(ids[at]), rank + 1, int(ids[i]), int(score[i])) for rank, i in enumerate(order))
    return out


def answers(spark, rows):
    return Counter(tuple(r) for r in knn.top_scores(table(spark, rows)).collect())


def test_top_scores_of_repeated_queries(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate((9 + rng.standard_normal((60, 4)), -9 + rng.standard_normal((60, 4)), [[9.0] * 4] * 30))
    rows = list(zip([*range(1, 121), *[200] * 30], x, strict=True))
    assert answers(spark, rows) == brute(rows)


def test_top_scores_where_one_id_or_one_vector_is_a_third_of_all_rows(spark):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((300, 8))
    rows = [(i, v) for i, v in enumerate(x[:100])] + [(40, v) for v in x[100:200]] + [(500 + i, x[3]) for i in range(100)] + [(20, x[20])]
    assert answers(spark, rows) == brute(rows)


@pytest.mark.parametrize("tight", [True, False])
def test_top_scores_over_many_cells_and_groups(spark, monkeypatch, tight):
    monkeypatch.setattr(knn, "ASKS", 24)
    monkeypatch.setattr(knn, "BLOCK", 500)
    sent = []
    route = knn.replicated
    monkeypatch.setattr(knn, "replicated", lambda *a: sent.append(route(*a)) or sent[-1])
    rng = np.random.default_rng(8)
    centre = rng.standard_normal((30, 12)) * (6 if tight else 0)
    x = centre[rng.integers(0, 30, 6000)] + rng.standard_normal((6000, 12))
    x[4000:4300] = x[0]
    x[5000:5100] = np.round(x[5000:5100])
    rows = list(enumerate(x))
    assert answers(spark, rows) == brute(rows)
    groups = sent[0].select("grp").distinct().count()
    assert groups >= 10 and (not tight or sent[0].count() < 0.5 * groups * 6000)


def test_top_scores_of_few_rows(spark):
    rows = [(20, [1.0, 2.0]), (40, [1.0, 2.0]), (3, [0.5, -1.0])]
    odd = [(60, None), (80, [1.0]), (None, [1.0, 1.0]), (100, [float("inf"), 0.0])]
    assert answers(spark, rows + odd) == brute(rows)
    assert not answers(spark, [(1, [1.0, 2.0])]) and not answers(spark, [])
