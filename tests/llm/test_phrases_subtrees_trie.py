"""Operators 11 to 13 against DuckDB, on tables and on small hostile ones."""

import random

import duckdb
import numpy as np
import pandas as pd
import pytest

from tagflow.llm import oracles, phrases, subtrees, trie
from tagflow.llm.common import table


def rows(df, names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def same(found, sql, **views):
    con = duckdb.connect()
    for name, view in views.items():
        if isinstance(view, str):
            con.sql(f"create view {name} as select * from '{view}'")
        else:
            con.register(name, view)
    out = con.execute(sql)
    names = [d[0] for d in out.description]
    assert sorted(names) == sorted(found.columns)
    want = sorted(out.fetchall(), key=str)
    assert rows(found, names) == want
    return want


@pytest.mark.parametrize(
    ("make", "name", "sql"),
    [(phrases.collocations, "documents", oracles.PHRASES), (subtrees.removal_digest, "documents", oracles.SUBTREES), (trie.prefix_trie, "conversations", oracles.TRIE)],
)
def test_whole_tables(spark, sf, make, name, sql):
    assert same(make(table(spark, sf, name)), sql, **{name: f"{sf}/{name}.parquet"})


# ---------------------------------------------------------------- phrases

def written_texts():
    roll = random.Random(3)
    words = ["a", "b", "B", "c", "é", "ÉÀ", "x y", "don't"]
    ends = [" ", "  ", "\t", ". ", ",", "\n", "\x0b", "!? "]
    lines = ["".join(roll.choice(words) + roll.choice(ends) for _ in range(roll.randrange(0, 60))) for _ in range(120)]
    return [(k, x, roll.choice(["en", "de", None])) for k, x in enumerate(lines)] + [(None, "a b c. a b", "en"), (7, None, "de"), (8, "", None), (9, "a b " * 3000, "en"), (9, "a b " * 3000, "en")]


def test_phrases_of_odd_texts(spark):
    frame = pd.DataFrame(written_texts(), columns=["doc_id", "text", "lang"]).astype({"doc_id": "Int64"})
    docs = spark.createDataFrame(written_texts(), "doc_id long, text string, lang string").selectExpr("*", "1 AS phrase", "2 AS words", "3 AS `n`", "4 AS `a``b`")
    want = same(phrases.collocations(docs.repartition(5)), oracles.PHRASES, documents=frame)
    assert {"en", "und"} <= {r[0] for r in want}


def test_phrases_of_no_rows(spark):
    assert phrases.collocations(spark.createDataFrame([], "doc_id long, text string, lang string")).collect() == []


def test_only_the_first_ranks_are_kept(spark):
    docs = spark.createDataFrame(written_texts(), "doc_id long, text string, lang string")
    whole = {(r.lang, r["rank"]): r.phrase for r in phrases.collocations(docs).collect()}
    few = {(r.lang, r["rank"]): r.phrase for r in phrases.collocations(docs, top=3).collect()}
    assert few == {k: v for k, v in whole.items() if k[1] <= 3}


def test_suffix_array_counts_every_phrase():
    roll = np.random.default_rng(5)
    at = roll.integers(0, 4, 3000)
    at[-1] = 0
    got = {}
    for first, n, count in phrases.suffix_counts(at):
        for f, c in zip(first, count, strict=True):
            key = tuple(at[f : f + n].tolist())
            assert key not in got
            got[key] = int(c)
    want = {}
    for n in (2, 3, 4):
        for i in range(len(at) - n + 1):
            key = tuple(at[i : i + n].tolist())
            if 0 not in key:
                want[key] = want.get(key, 0) + 1
    assert got == want


def test_scores_of_counts_beyond_64_bits(spark):
    f = 6_000_000_000_000_000_000
    found = spark.createDataFrame([("en", "a", 1, f), ("en", "b", 1, f), ("en", "a b", 2, f - 7)], "lang string, phrase string, words int, f long")
    assert [r.score for r in phrases.scored(found).collect()] == [2_000_000 * (f - 7) // (2 * f)]


# ---------------------------------------------------------------- subtrees

def repeated_texts():
    roll = random.Random(4)
    foot = " ".join(f"foot{k}" for k in range(20))
    loop = "na " * 40
    out = [(k, f"start{k} {foot} mid{k}\t{loop}") for k in range(150)]
    out += [(1000 + k, "x " * (k % 30)) for k in range(60)]
    long = [f"w{roll.randrange(300)}" for _ in range(4000)]
    out += [(2000, " ".join(long)), (2001, " ".join(long)), (2002, " ".join(long[100:900] + ["new"] + long[901:])), (2003, "\n".join(long[5:]))]
    return out + [(3000, "é è " * 30), (3001, "é è " * 14), (3002, "é è " * 14)]


@pytest.mark.parametrize("group_bytes", [subtrees.GROUP_BYTES, 4000, 300])
def test_windows_go_whatever_the_groups(spark, group_bytes):
    """Small groups make prefixes too large, up to whole windows."""
    frame = pd.DataFrame(repeated_texts(), columns=["doc_id", "text"])
    docs = spark.createDataFrame(frame).selectExpr("*", "1 AS mark", "2 AS `full`", "3 AS `open`")
    same(subtrees.removal_digest(docs, group_bytes=group_bytes), oracles.SUBTREES, documents=frame)


def test_subtrees_of_nulls_and_repeated_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(None, text), (5, text), (5, text), (6, None), (7, ""), (8, text + " more"), (8, "short")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in subtrees.removal_digest(docs).collect())
    assert got == [("5", 30, 0), ("5", 30, 0), ("6", 0, 0), ("7", 0, 0), ("8", 1, 0), ("8", 31, 30), ("None", 30, 0)]
    assert subtrees.removal_digest(docs.limit(0)).collect() == []


def test_deep_nodes_are_the_classes_of_equal_windows():
    roll = np.random.default_rng(6)
    window = roll.integers(0, 2, (500, 5)).astype(np.uint8)
    order, head = subtrees.deep_nodes(window, np.zeros(500, np.uint64), 5)
    sorted_rows = [tuple(x) for x in window[order]]
    assert len(head) == len(set(sorted_rows))
    assert all(k == 0 or sorted_rows[k] != sorted_rows[k - 1] for k in head)


# ---------------------------------------------------------------- trie

def talks():
    roll = random.Random(8)
    out = []
    for c in [*range(0, 40), *range(100, 130), *range(250, 260), 700]:
        out += [(c, k, roll.choice(["user", "assistant"]), roll.choice(["hi", "yes", "né"])) for k in range(roll.randrange(1, 5))]
    long = [(k, "user", f"turn {k}") for k in range(300)]
    out += [(c, *t) for c in (401, 402, 403) for t in long] + [(404, *t) for t in long[:200]] + [(405, *t) for t in long[:200]] + [(405, 999, "user", "else")]
    out += [(500, None, None, "first"), (500, 3, "user", None), (500, 3, "user", None), (500, 3, "a", "b"), (501, 0, None, None)]
    return out


def test_trie_of_odd_conversations(spark):
    frame = pd.DataFrame(talks(), columns=["conv_id", "turn", "role", "text"]).astype({"turn": "Int64"})
    given = spark.createDataFrame([*talks(), (None, 1, "user", "nobody")], "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS c", "2 AS rep", "3 AS d")
    want = same(trie.prefix_trie(given.repartition(7)), oracles.TRIE, conversations=frame)
    assert max(r[1] for r in want) >= 290


def test_trie_of_copies_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 3)
    monkeypatch.setattr(trie, "PIECE", 4)
    made = [(c, k, "user", f"t{k}") for c in range(600, 640) for k in range(11)] + [(c, k, "user", f"t{k}") for c in (641, 642) for k in range(8)]
    frame = pd.DataFrame(made, columns=["conv_id", "turn", "role", "text"])
    same(trie.prefix_trie(spark.createDataFrame(frame)), oracles.TRIE, conversations=frame)


def test_trie_of_no_rows(spark):
    assert trie.prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
