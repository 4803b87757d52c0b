"""Rule matching by broadcast and by tags gives the same rows."""

from collections import Counter

import pytest

from tagflow.operators import rules as R

OPS = "lid string, bucket string, key string, object_tags map<string,string>"
ops_rows = [
    ("a", "b1", "u/1/x", {"p": "1", "q": "2"}),
    ("b", "b1", "u/10", {"p": "1"}),
    ("c", "b1", "v/1", {"q": "2", "z": None}),
    ("d", "b2", "u/1", {"p": "1", "q": "2", "r": "3"}),
    ("e", "b1", "", {}),
    ("f", "b3", "u/1", {"P": "1", "p": "2"}),
]
CASES = {
    "superset, missing tag, wrong value, case of a key": [("b1", "c", "r1", {"p": "1"}, "d", None), ("b1", "c", "r2", {"p": "2"}, "d", None), ("b3", "c", "r3", {"p": "1"}, "d", None)],
    "prefixes": [("b1", "c", "r1", {"p": "1"}, "d", "u/1"), ("b1", "c", "r2", {"p": "1"}, "d", "u/1/"), ("b1", "c", "r3", {"p": "1"}, "d", "w")],
    "two rules without an id that an operation holds both of": [("b1", "c", "", {"p": "1"}, "d", None), ("b1", "c", "", {"q": "2"}, "d", None)],
    "two rules without an id of which it holds one tag each": [("b1", "c", "", {"p": "1", "x": "9"}, "d", None), ("b1", "c", "", {"q": "2", "y": "9"}, "d", None)],
    "a rule listed twice": [("b1", "c", "r", {"p": "1", "q": "2"}, "d", None)] * 2,
    "a rule without tags, and one with a prefix": [("b1", "c", "r", {}, "d", None), ("b1", "c", "s", {}, "d", "u/")],
    "a tag with a null value": [("b1", "c", "r", {"z": None}, "d", None), ("b1", "c", "s", {"q": "2", "z": None}, "d", None)],
    "null and empty destinations": [("b2", "c", "r", {"r": "3"}, None, None), ("b2", "c", "s", {"r": "3", "p": "1"}, "", None)],
    "more prefix lengths than are indexed, keys shorter than them": [("b1", "c", f"r{n}", {}, "d", "u/1/x"[:n]) for n in range(1, 6)] + [("b1", "c", "long", {"p": "1"}, "d", "u/1/x" * 300)],
    "an empty prefix": [("b1", "c", "r", {"p": "1"}, "d", ""), ("b1", "c", "s", {}, "d", "")],
    "no rules": [],
}


@pytest.mark.parametrize("name", CASES)
def test_same_rows(spark, monkeypatch, name):
    ops, rules = spark.createDataFrame(ops_rows, OPS), spark.createDataFrame(CASES[name], R.SCHEMA)
    columns = ["lid", "config_id", "rule_id", "tag_filter", "destination_arn", "key_prefix"]
    rows = lambda df: Counter(str(tuple(r)) for r in df.select(*columns).collect())
    monkeypatch.setattr(R, "LENGTHS", 2)
    few = rows(R.match(ops, rules))
    monkeypatch.setattr(R, "BROADCAST_RULES", -1)
    assert rows(R.match(ops, rules)) == few == rows(R.match_by_tags(ops, rules))
    monkeypatch.setattr(R, "SALT_ROWS", 1)
    assert rows(R.match(ops, rules)) == few
    want = Counter()
    for lid, bucket, key, tags in ops_rows:
        for b, config, rule, needed, dest, prefix in CASES[name]:
            if b == bucket and all(tags.get(k) == v for k, v in needed.items()) and key.startswith(prefix or ""):
                want[lid, rule, prefix] += 1
    got = Counter()
    for r in R.match(ops, rules).collect():
        got[r.lid, r.rule_id, r.key_prefix] += 1
    assert got == want


def test_too_many_rules_for_one_condition_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(R, "PREDICATE_RULES", 3)
    rules = spark.createDataFrame([("b", "c", f"r{k}", {"p": str(k)}, "d", None) for k in range(4)], R.SCHEMA)
    ops = spark.createDataFrame(ops_rows, OPS)
    assert ops.where(R.predicate_of(rules.limit(3))).count() == 4
    with pytest.raises(ValueError, match="more than 3 rules"):
        R.predicate_of(rules)


def test_the_index_tries_a_tenth_of_the_pairs(spark):
    ops = spark.range(2000).selectExpr("cast(id as string) lid", "'b' bucket", "concat('u/', id % 500, '/x') key", "map('type', if(id % 2 = 0, 'a', 'b'), 'k', cast(id % 50 as string)) object_tags")
    made = [("b", "c", f"r{k}", {"type": "a"} | ({"k": str(k % 50)} if k % 2 else {}), "d", None if k % 2 else f"u/{k}/") for k in range(300)]
    rules = spark.createDataFrame([*made, ("b", "c", "never", {"type": "a", "none": "1"}, "d", None)], R.SCHEMA)
    by_tags = ops.where("object_tags['type'] = 'a'").count() * len(made)
    assert R.candidates(ops, rules).count() * 10 <= by_tags
    rows = lambda df: sorted((r.lid, r.rule_id) for r in df.select("lid", "rule_id").collect())
    assert rows(R.match_by_index(ops, rules)) == rows(R.match(ops, rules)) != []


def test_rules_with_one_condition_are_tested_once(spark, monkeypatch):
    ops = spark.range(100).selectExpr("cast(id as string) lid", "'b' bucket", "concat('u/', id) key", "map('k', cast(id % 10 as string)) object_tags")
    made = [("b", f"c{k}", f"r{k}", {"k": str(k % 5)}, "d", None) for k in range(200)]
    rules = spark.createDataFrame([*made, made[0], made[0], made[5]], R.SCHEMA)
    monkeypatch.setattr(R, "MEMBERS", 10)
    # 200 different rules with 5 conditions, in about 10 rows each
    assert R.together(rules).count() < 60
    rows = lambda df: sorted((r.lid, r.config_id, r.rule_id) for r in df.select("lid", "config_id", "rule_id").collect())
    assert rows(R.match_by_index(ops, rules)) == rows(R.match(ops, rules)) and R.match_by_index(ops, rules).count() == 50 * 40 + 30


def test_conditions_with_the_most_matches_are_crossed(spark, monkeypatch):
    ops = spark.range(100).selectExpr("cast(id as string) lid", "'b' bucket", "concat('u/', id) key", "map('k', cast(id % 10 as string)) object_tags")
    made = [("b", f"c{k}", f"r{k}", {"k": str(k % 5)}, "d", None if k % 3 else "u/") for k in range(200)]
    rules = spark.createDataFrame([*made, made[0], made[0], made[5]], R.SCHEMA)
    columns = ["lid", "config_id", "rule_id", "tag_filter", "destination_arn", "key_prefix"]
    rows = lambda df: sorted(str(tuple(r)) for r in df.select(*columns).collect())
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    want = rows(R.match(ops, rules))
    for name, n in (("PAIRS", 50), ("CROSSED", 3), ("CROSSED_OPS", 4), ("CROSSED_RULES", 5)):
        monkeypatch.setattr(R, name, n)
    # ten conditions with 10 operations and 13 or more rules each: three are crossed, all others unfolded by salts
    got = R.match_by_index(ops, rules)
    assert plan(got).count("CartesianProduct") == 3 and rows(got) == want and len(want) == 50 * 40 + 30
    monkeypatch.setattr(R, "CROSSED", 100)
    assert plan(R.match_by_index(ops, rules)).count("CartesianProduct") == 10 and rows(R.match_by_index(ops, rules)) == want


def test_a_full_map_of_terms_loses_none(spark, monkeypatch):
    ops, rules = spark.createDataFrame(ops_rows, OPS), spark.createDataFrame([("b1", "c", f"r{k}", {"p": str(k)}, "d", "u/1") for k in range(100)], R.SCHEMA)
    rows = lambda df: sorted((r.lid, r.rule_id) for r in df.select("lid", "rule_id").collect())
    monkeypatch.setattr(R, "BITS", 64)
    assert rows(R.match_by_index(ops, rules)) == rows(R.match(ops, rules)) == [("a", "r1"), ("b", "r1")]


def test_unknown_tags_are_error_rows(spark):
    ops = spark.createDataFrame([("a", "b", "k", None), ("c", "b", "l", {}), ("d", None, None, None)], OPS)
    assert sorted(map(str, R.errors(ops).collect())) == sorted(map(str, spark.createDataFrame([("b", "k", "indeterminate tags"), (None, None, "indeterminate tags")], "bucket string, key string, reason string").collect()))
    rules = spark.createDataFrame([("b", "c", "r", {}, "d", None)], R.SCHEMA)
    assert [r.lid for r in R.match_by_index(ops, rules).collect()] == [r.lid for r in R.match(ops, rules).collect()] == ["c"]
