"""Generations of the processed window: what holds, what is void, what is written, what leaves the list."""

from datetime import date, datetime, timedelta
from pathlib import Path
from random import random

from pyspark.sql import functions as F

from tagflow.plans import catalogue
from tagflow.sources import processed as W

T = datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(b, i, T + timedelta(days=d)) for b, i, d in rows], W.SCHEMA)


def held(spark, window):
    return {(r.bucket, r.lid, (r.watermark - T).days) for r in W.read(spark, window).collect()}


def test_rows_after_a_mark_that_was_set_back_are_void_in_earlier_generations(spark, tmp_path):
    root = str(tmp_path / "w")
    one = W.append(spark, None, root, frame(spark, [("a", f"x{k}", k % 3) for k in range(9)] + [("b", "y", 2)]), 10, {}, None)
    two = W.append(spark, one, root, frame(spark, [("a", "x2", 2)]), 1, {"a": T}, None)
    assert len(two["generations"]) == 2 and len(two["cuts"]) == 1
    want = {("a", "x0", 0), ("a", "x3", 0), ("a", "x6", 0), ("a", "x2", 2), ("b", "y", 2)}
    assert held(spark, two) == want
    # a merge leaves the void rows out and needs the cut no more
    three = W.append(spark, two, root, frame(spark, [("c", f"z{k}", 1) for k in range(20)]), 20, {}, None)
    assert len(three["generations"]) == 1 and three["cuts"] == [] and held(spark, three) == want | {("c", f"z{k}", 1) for k in range(20)}
    # an older list still reads as it did
    assert held(spark, two) == want


def test_days_before_the_window_leave_the_list_and_empty_generations_too(spark, tmp_path):
    root = str(tmp_path / "w")
    window = W.append(spark, None, root, frame(spark, [("a", f"x{k}", k) for k in range(8)]), 8, {}, None)
    window = W.append(spark, window, root, frame(spark, [("a", "late", 6)]), 1, {}, date(2024, 1, 6))
    assert held(spark, window) == {("a", "x5", 5), ("a", "x6", 6), ("a", "x7", 7), ("a", "late", 6)}
    assert len(W.folders(window)) == 2
    window = W.append(spark, window, root, frame(spark, []), 0, {}, date(2025, 1, 1))
    assert held(spark, window) == set() and window["generations"] == []


def test_a_run_writes_its_own_rows_and_old_windows_are_taken_in(spark, tmp_path):
    root = str(tmp_path / "w")
    frame(spark, [("a", f"x{k}", k % 2) for k in range(40)]).write.parquet(str(tmp_path / "old"))
    window = W.append(spark, str(tmp_path / "old"), root, frame(spark, [("a", "n", 3)]), 1, {"a": T}, None)
    assert len(held(spark, window)) == 21
    first = set(Path(root).rglob("*.parquet"))
    window = W.append(spark, window, root, frame(spark, [("b", "n", 3)]), 1, {}, None)
    assert [g["rows"] for g in window["generations"]] == [21, 1]
    assert len(set(Path(root).rglob("*.parquet")) - first) == 1
    assert held(spark, window) >= {("b", "n", 3), ("a", "n", 3)}


def test_the_rows_of_the_runs_are_made_once(spark, sf, monkeypatch):
    """Rows that come out in another run each time they are made: every id is still in the window, and once."""
    newest, other = catalogue.newest, F.udf(lambda: int(random() * 3), "long").asNondeterministic()
    monkeypatch.setattr(catalogue, "newest", lambda spark, sf: newest(spark, sf).withColumn("sequence_number", other()))
    monkeypatch.setattr(catalogue, "MARK", datetime(2030, 1, 1))
    rows = catalogue.queries()["window_generations"](spark, sf)
    assert rows.count() == rows.select("lid").distinct().count() == newest(spark, sf).count()
