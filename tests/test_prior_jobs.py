"""Jobs of earlier runs: outcomes, merged reports, diagnoses, and that the first do not depend on the others."""

import datetime as dt

import pytest

from tagflow.plans import interval as I
from tagflow.plans import prior_jobs as K
from tagflow.plans.tracking import ITEMS
from tagflow.sources.items import ItemTable
from tagflow.sources.sinks import StateStore

T0 = dt.datetime(2024, 1, 10)
STORED = "bucket string, key string, version_id string, tagged_at timestamp_ntz, rules array<string>, destinations array<string>"
STATUS = "job_id string, status string, tasks_succeeded long, tasks_failed long"


class Setting:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)
        self.store = StateStore(spark, f"{folder}/state")
        self.table = ItemTable(spark, self.store, f"{folder}/items", ITEMS, 4)
        entry = lambda job, day: {"watermark": T0.isoformat(), "submission": {"job": job, "low": T0.isoformat(), "failures": 1, "at": (T0 + dt.timedelta(day)).isoformat()}}
        self.store.write(I.STATE, {"buckets": {"a": entry("j1", 0), "b": entry("j2", 1), "c": entry("j3", 2), "d": entry("j4", 3), "e": {"watermark": None}}, "window": None}, None)
        rows = [("j1", 0, "a", "x", None, None, None), ("j1", 1, "a", "y", "v", "AccessDenied", "no"), ("j1", 2, "a", "z", None, "AccessDenied", "late"), ("j1", 3, "a", "x", None, None, None), ("j3", 0, "c", "x", None, None, None), ("old", 0, "a", "w", None, None, None)]
        self.reports = spark.createDataFrame(rows, K.REPORTS)
        self.statuses = spark.createDataFrame([("j1", "Complete", 1, 2), ("j2", "Failed", 0, 0), ("j3", "Active", 0, 0), ("zz", "Failed", 0, 0)], STATUS)
        self.stored = spark.createDataFrame([("a", "x", None, T0, ["r"], ["d"]), ("a", "y", None, T0, ["q"], None)], STORED)
        self.alerted = spark.createDataFrame([("a", "a"), ("b", "b")], "bucket string, config_id string")

    def run(self, reports=None):
        return K.with_outcomes(self.table, self.store, self.statuses, self.reports if reports is None else reports, self.stored, self.alerted, self.folder)

    def items(self):
        return sorted(((r.bucket, r.key, r.version_id, {k: (v.job_id, v.manifest_at, v.confirmed) for k, v in r.configs.items()}, r.state, r.tagged_at, r.rules) for r in self.table.items().collect()), key=str)


@pytest.fixture
def setting(spark, tmp_path):
    return Setting(spark, tmp_path)


def test_reports_of_ended_jobs_are_merged_and_diagnosed_once(setting):
    found = setting.run()
    assert found.errors == {} and found.rewritten
    entry = {"a": ("j1", T0, True)}
    held = [("a", "x", None, entry, "PENDING", T0, ["r"]), ("a", "y", "v", entry, "PENDING", None, None), ("a", "z", None, entry, "PENDING", None, None)]
    assert setting.items() == held
    assert sorted((r.job_id, r.failed) for r in found.outcomes.collect()) == [("j1", False), ("j2", True), ("j3", False)]
    assert [(r.job_id, r.error_code, r.n, r.message) for r in found.diagnoses.collect()] == [("j1", "AccessDenied", 2, "no")]
    assert [(r.bucket, r.config_id) for r in found.alerted.collect()] == [("b", "b")]
    again = setting.run()
    assert (again.rewritten, again.diagnoses.count(), setting.items()) == ([], 0, held)
    # the failed job's report comes in late
    late = setting.spark.createDataFrame([("j2", 0, "b", "x", None, "Other", None)], K.REPORTS)
    found = setting.run(setting.reports.unionByName(late))
    assert [(r.job_id, r.error_code, r.cause) for r in found.diagnoses.collect()] == [("j2", "Other", "a task failed")]
    assert len(setting.items()) == 4 and sorted(r.bucket for r in found.alerted.collect()) == ["a"]


def test_outcomes_feed_the_recovery_of_the_next_run(setting):
    plan = {r.bucket: r for r in I.S.recovery_plan(setting.run().outcomes, 2).collect()}
    assert (plan["b"].consecutive_failures, plan["b"].disable, plan["b"].rollback_to) == (2, True, T0.isoformat())
    assert (plan["a"].consecutive_failures, plan["a"].disable) == (0, False)
    entries = I.recovered(setting.store.read(I.STATE)[0]["buckets"], setting.run().outcomes, 2)
    assert entries["b"]["disabled"] and "submission" not in entries["a"] and "submission" in entries["c"]


def test_a_merge_that_fails_leaves_outcomes_and_diagnoses(setting, monkeypatch):
    monkeypatch.setattr(setting.table, "merge", lambda *_: 1 / 0)
    found = setting.run()
    assert list(found.errors) == ["merge"] and setting.items() == []
    assert found.outcomes.count() == 3 and found.diagnoses.count() == 1 and found.alerted.count() == 2
    monkeypatch.undo()
    assert setting.run().errors == {} and len(setting.items()) == 3


def test_nothing_on_record(spark, tmp_path, setting):
    store = StateStore(spark, str(tmp_path / "empty"))
    assert K.records_of(spark, store).count() == 0
    found = K.inspected(setting.table, K.records_of(spark, store), setting.statuses, setting.reports, setting.stored, setting.alerted, str(tmp_path / "e"))
    assert (found.outcomes.count(), found.rewritten, found.errors) == (0, [], {})
