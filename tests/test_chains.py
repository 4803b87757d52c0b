"""Chains along ordered rows against a loop."""

import random

import pytest

from tagflow.operators import chains
from tagflow.operators import state as S


def looped(data, budget, over):
    out, at = {}, None
    for bucket, i, size in sorted(data):
        if bucket != at:
            at, link, room, first = bucket, 0, budget, True
        if not first and (room <= 0 if over else size > room):
            link, room = link + 1, budget
        room, first = room - size, False
        out[bucket, i] = link
    return out


@pytest.mark.parametrize(("budget", "over"), [(1, False), (1, True), (12, False), (12, True), (200, True), (100_000, False)])
def test_links_are_those_of_a_loop(spark, budget, over):
    roll = random.Random(budget)
    data = [(b, i, roll.choice([0, 1, 1, 2, 5, 9, 30])) for b in ("a", "b") for i in range(150)] + [("z", 0, 100)]
    rows = spark.createDataFrame(data, "bucket string, i long, size long").repartition(3)
    got = {(r.bucket, r.i): r.link for r in chains.linked(rows, ["bucket"], ["i"], "size", budget, over).collect()}
    assert got == looped(data, budget, over)


def test_places_of_equal_rows(spark):
    rows = spark.createDataFrame([("a", 1, 2)] * 7 + [("b", 1, 3)], "bucket string, i long, n long").repartition(3)
    got = sorted((r.bucket, r.pos, r.before) for r in chains.placed(rows, ["bucket"], ["i"], "n").collect())
    assert got == [("a", k, 2 * k) for k in range(7)] + [("b", 0, 0)]


def test_no_rows(spark):
    assert chains.linked(spark.createDataFrame([], "bucket string, i long, size long"), ["bucket"], ["i"], "size", 5).collect() == []


def test_a_bucket_with_many_groups(spark):
    groups = spark.range(200_000).selectExpr("'a' AS bucket", "id AS name", "10L AS size")
    last = S.chunked_groups(groups, ["name"], 100).agg({"chunk": "max"}).first()[0]
    assert last == 19_999
