"""Runs over all buckets: what is sent, how marks and windows move, failures, caps; settings and reports."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tagflow.operators import reports as P
from tagflow.operators import rules as R
from tagflow.operators import settings as G
from tagflow.plans import catalogue
from tagflow.plans import interval as I
from tagflow.sources.sinks import StateConflict, StateStore

START = datetime(2024, 1, 5)
BUCKETS = ["lake-0", "lake-1", "lake-2"]


@pytest.fixture
def run(spark, sf, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    I.seed(store, BUCKETS, START)
    journal = catalogue.journal(spark, sf)

    def call(submit=lambda *_: I.SUBMITTED, cap=500_000, **more):
        return I.run_interval(spark, journal, R.inline_rules(spark), store, submit, str(tmp_path / "runs"), G.Settings(row_cap=cap), **more)

    call.store = store
    return call


def test_second_run_sends_nothing(run):
    first = run()
    assert first.progressed and not first.capped
    assert sum(m["object_count"] for m in first.manifests.values()) > 0
    assert all(f["MD5checksum"] and f["size"] for m in first.manifests.values() for f in m["files"])
    second = run()
    assert second.answers == {} and second.marks == first.marks


def test_marks_move_for_sent_buckets_only(run):
    out = run(lambda bucket, *_: I.SUBMITTED if bucket == "lake-0" else I.TRANSIENT)
    assert out.marks["lake-0"] > START and out.marks["lake-1"] == START
    again = run()
    assert "lake-0" not in again.answers and "lake-1" in again.answers


def test_an_exception_of_the_sink_is_another_try(run):
    def broken(*_):
        raise OSError("no answer")

    before = run.store.read(I.STATE)[0]
    assert set(run(broken).answers.values()) == {I.TRANSIENT}
    assert run.store.read(I.STATE)[0] == before


def test_permanent_failures_disable_a_bucket(run):
    answer = lambda bucket, *_: I.PERMANENT if bucket == "lake-0" else I.SUBMITTED
    outs = [run(answer) for _ in range(3)]
    assert [o.disabled for o in outs] == [[], [], ["lake-0"]]
    assert "lake-0" not in run(answer).answers


def test_failed_jobs_set_the_mark_back_for_one_run(run, spark):
    first = run()
    schema = "bucket string, status string, tasks_succeeded long, tasks_failed long, consecutive_failures int, watermark_low string"
    failed = spark.createDataFrame([("lake-0", "Failed", 0, 1, 0, "2024-01-05T00:00:00.000000Z")], schema)
    again = run(outcomes=failed)
    assert set(again.answers) == {"lake-0"}
    assert again.manifests["lake-0"]["object_count"] == first.manifests["lake-0"]["object_count"]


def test_capped_runs_reach_the_end_in_a_chain(run, spark, sf):
    outs = I.drain(lambda: run(cap=200), G.Settings())
    assert len(outs) > 1 and outs[0].capped
    assert not (outs[-1].capped and outs[-1].progressed)


def test_state_is_not_written_over_a_newer_version(run):
    document, version = run.store.read(I.STATE)
    run.store.write(I.STATE, document, version)
    with pytest.raises(StateConflict):
        run.store.write(I.STATE, document, version)


def test_empty_journal(spark, sf, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    I.seed(store, BUCKETS, START)
    empty = catalogue.journal(spark, sf).where(F.lit(False))
    out = I.run_interval(spark, empty, R.inline_rules(spark), store, lambda *_: I.SUBMITTED, str(tmp_path / "r"), G.Settings())
    assert out.answers == {} and set(out.marks.values()) == {START}


@pytest.mark.parametrize("entry", ["x", {"name": "ab", "region": "eu-west-1"}, {"name": "a..b", "region": "eu-west-1"}, {"name": "10.0.0.1", "region": "eu-west-1"}, {"name": "good", "region": "EU_1"}, {"name": "good"}, {"name": "good", "region": "eu-west-1", "destination": "d"}])
def test_configuration_is_all_or_nothing(spark, entry):
    good = {"name": "my-bucket", "region": "eu-west-1"}
    assert G.buckets(spark, {"buckets": [good]}).count() == 1
    for document in ({"buckets": [good, entry]}, {"buckets": []}, {"buckets": [good, good]}, {}, None):
        with pytest.raises(G.ConfigError):
            G.buckets(spark, document)


def test_unusable_settings_give_defaults():
    s = G.Settings.from_env({"TAGFLOW_ROW_CAP": "0", "TAGFLOW_LOOKBACK_S": "0", "TAGFLOW_CHAIN_LIMIT": "-3", "TAGFLOW_FAILURE_THRESHOLD": " 5 "})
    assert (s.row_cap, s.lookback_s, s.chain_limit, s.failure_threshold) == (500_000, 0, 20, 5)
    assert [G.should_continue(True, True, d, 20) for d in (-1, 19, 20)] == [True, True, False]


def test_summary_and_subject(spark):
    items = spark.createDataFrame([("b", "COMPLETE"), ("c" * 90, None), ("c" * 90, "FAILED"), ("c" * 90, "COMPLETE")], "bucket string, outcome string")
    got = {r.bucket: r for r in P.outcome_summary(items).collect()}
    assert got["b"].summary == "b: 1 object replicated successfully. No action needed."
    assert got["b"].subject == "S3 replication b: 1 object, no failures"
    long = got["c" * 90]
    assert long.summary.endswith("1 failed to replicate; 1 reported no replication status; 1 replicated successfully. Action needed: 2 of 3 did not replicate.")
    assert len(long.subject) == 100 and long.subject.endswith("...: 3 objects, action needed")
