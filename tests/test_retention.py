"""Run folders that state names, or that are young, stay."""

import datetime as dt
import os

from tagflow.sources.sinks import StateStore, swept


def test_only_old_folders_without_a_name_go(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    store.write("interval", {"window": f"{tmp_path}/named/window", "buckets": {"b": {"paths": [f"{tmp_path}/listed"]}}}, None)
    now = dt.datetime(2024, 1, 10)
    for name, day in (("named", 1), ("listed", 1), ("old", 1), ("older", 2), ("young", 9)):
        (tmp_path / name / "window").mkdir(parents=True)
        at = dt.datetime(2024, 1, day, tzinfo=dt.UTC).timestamp()
        os.utime(tmp_path / name, (at, at))
    os.utime(tmp_path / "state", (0, 0))
    root = str(tmp_path)
    assert swept(spark, root, [(store, "interval")], now, 7 * 86400, ("state",)) == ["old", "older"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["listed", "named", "state", "young"]
    assert swept(spark, root, [(store, "interval")], now, 0, ("state",)) == ["young"]


def test_the_entry_names_what_is_missing(monkeypatch):
    import sys
    import warnings

    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "tagflow.llm", None)
    monkeypatch.setitem(sys.modules, "tagflow.llm.queries", None)
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        names = set(entry.queries())
    assert "manifest_minus_deletes" in names
    assert not any(n.startswith("op") and n[2].isdigit() for n in names)
    assert any("tagflow.llm" in str(w.message) for w in seen)
