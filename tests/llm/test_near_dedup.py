"""The pipeline's near-dedup against brute-force five-word Jaccard components."""

import re

import numpy as np

from tagflow.llm import simhash

WORDS = [f"w{k}" for k in range(3000)]
SCHEMA = "doc_id long, text string, mark int"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def kept_by_brute_force(rows, similarity=0.8):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if min(len(sets[i]), len(sets[j])) >= 0.7 * max(len(sets[i]), len(sets[j])) and jaccard(sets[i], sets[j]) >= similarity:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [i for i in ids if top(i) == i]


def prose(rng, n):
    return list(rng.choice(WORDS, n))


def edited(rng, words, changes):
    out = list(words)
    for k in rng.choice(len(out), changes, replace=False):
        out[k] = "changed"
    return out


def corpus():
    """Edited copies at similarities of about 0.6 to 0.99, chains of edits, repeated lines, appended text, odd texts."""
    rng = np.random.default_rng(11)
    texts = [None, "", "  ", "one", "One", "one two three four five six", "one two three four five six seven"]
    for k in range(60):
        base = prose(rng, 400)
        texts += [" ".join(base), " ".join(edited(rng, base, 1 + k % 20))]
    for _ in range(15):
        base = prose(rng, 400)
        line = base[50:65]
        texts += [" ".join(base), " ".join(base + line * 5), "\n".join([" ".join(base), *[" ".join(line)] * 20])]
    for _ in range(8):
        base = prose(rng, 300)
        for _ in range(5):
            texts.append(" ".join(base))
            base = edited(rng, base, 6)
    for k in range(30):
        base = prose(rng, 300)
        texts += [" ".join(base), " ".join(base + prose(rng, 40 + 4 * k))]
    order = rng.permutation(len(texts))
    return [(int(i), texts[i]) for i in order]


def test_near_dedup_equals_brute_force(spark):
    rows = corpus()
    assert sum(0.7 <= jaccard(shingles(x), shingles(y)) < 0.8 for (_, x), (_, y) in zip(sorted(rows)[7:], sorted(rows)[8:], strict=False)) > 10
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], SCHEMA)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == kept_by_brute_force(rows)


def test_near_dedup_links_texts_with_repeated_lines(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(100):
        base = prose(rng, 400)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base + base[50:65] * (5 if k % 2 else 20)))]
    kept = simhash.keep_one(spark.createDataFrame([(i, t, 1) for i, t in rows], SCHEMA)).collect()
    assert sorted(r.doc_id for r in kept) == list(range(0, 200, 2))


def test_near_dedup_keeps_texts_below_the_similarity(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(100):
        base = prose(rng, 300)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:261] + prose(rng, 39)))]
    assert all(0.74 < jaccard(shingles(rows[2 * k][1]), shingles(rows[2 * k + 1][1])) < 0.8 for k in range(100))
    assert simhash.keep_one(spark.createDataFrame([(i, t, 1) for i, t in rows], SCHEMA)).count() == 200


def test_near_dedup_is_linked_by_other_pairs_where_a_forest_fails(spark, monkeypatch):
    """Every forest is made of the worst pairs, and groups are cut into blocks: the rest must come from the second comparison."""
    monkeypatch.setattr(simhash, "GROUP_BLOCK", 2)
    forest = simhash._forest
    monkeypatch.setattr(simhash, "_forest", lambda count, i, j, off: (lambda f: (*f[:2], -f[2]))(forest(count, i, j, -off)))
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(20):
        base = prose(rng, 300)
        for _ in range(5):
            rows.append((len(rows), " ".join(base)))
            base = edited(rng, base, 6)
    kept = simhash.keep_one(spark.createDataFrame([(i, t, 1) for i, t in rows], SCHEMA)).collect()
    assert sorted(r.doc_id for r in kept) == kept_by_brute_force(rows)
