"""Sketches against exact counts, and what a run counts, audits and puts on record."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tagflow.operators import preflight as B
from tagflow.operators import rules as R
from tagflow.operators import settings as G
from tagflow.plans import catalogue
from tagflow.plans import interval as I
from tagflow.sources.sinks import StateStore

BUCKETS = ["lake-0", "lake-1", "lake-2"]
STATUS = "job_id string, status string, tasks_succeeded long, tasks_failed long"


def test_united_sketches_stay_inside_the_margin(spark):
    ops = spark.range(200_000).select(F.lit("b").alias("bucket"), F.concat(F.lit("k"), F.col("id") % 60_000).alias("key"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id % 48)").alias("record_timestamp"))
    exact = {r[0]: r[1] for r in ops.groupBy(F.to_date("record_timestamp")).agg(F.count_distinct("key")).collect()}
    got = B.estimated(B.sketched(ops), F.to_date("hour")).collect()
    assert len(got) == len(exact) == 2
    assert all(abs(r.estimate - exact[r.period]) <= B.MARGIN * exact[r.period] for r in got)


def test_only_periods_near_the_limit_are_counted(spark):
    sizes = {"few": 10, "under": 980, "at": 1000, "over": 1001, "many": 5000}
    rows = [(b, f"k{k}", datetime(2024, 1, 1, k % 24)) for b, n in sizes.items() for k in range(n)] + [("few", None, datetime(2024, 1, 1)), (None, "k", datetime(2024, 1, 1)), ("few", "k", None)]
    got = {r.bucket: (r.exact, r.over_limit) for r in B.over_limit(spark.createDataFrame(rows, "bucket string, key string, record_timestamp timestamp_ntz"), 1000).collect()}
    assert got == {"few": (None, False), "under": (980, False), "at": (1000, False), "over": (1001, True), "many": (None, True), None: (None, False)}


@pytest.fixture
def run(spark, sf, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    I.seed(store, BUCKETS, datetime(2024, 1, 5))
    journal = catalogue.journal(spark, sf)

    def call(cap=500_000, submit=lambda *_: I.SUBMITTED, **more):
        return I.run_interval(spark, journal, R.inline_rules(spark), store, submit, str(tmp_path / "runs"), G.Settings(row_cap=cap), **more)

    call.store = store
    call.entries = lambda: store.read(I.STATE)[0]["buckets"]
    return call


def test_a_failed_job_on_record_is_sent_again_and_one_that_ended_well_is_dropped(spark, run):
    first = run(count_scans=True)
    sent = {b: e["submission"] for b, e in run.entries().items() if "submission" in e}
    assert set(sent) == set(first.answers) and all(sent[b]["objects"] == first.manifests[b]["object_count"] and sent[b]["low"].startswith("2024-01-05") for b in sent)
    assert all(first.scans[b] >= first.manifests[b]["object_count"] for b in sent)
    bad, good, *_ = sorted(sent)
    statuses = spark.createDataFrame([(sent[bad]["job"], "Failed", 0, 1), (sent[good]["job"], "Complete", 1, 0), ("other", "Failed", 0, 1)], STATUS)
    # not taken this time: the failed job stays on record, the other is dropped in the same write
    again = run(outcomes=I.outcomes_of(spark, run.store, statuses), submit=lambda *_: I.TRANSIENT)
    assert set(again.answers) == {bad}
    assert run.entries()[bad]["submission"] == sent[bad] and "submission" not in run.entries()[good]
    third = run(outcomes=I.outcomes_of(spark, run.store, statuses))
    assert third.answers == {bad: I.SUBMITTED} and third.manifests[bad]["object_count"] == first.manifests[bad]["object_count"]
    assert run.entries()[bad]["submission"]["failures"] == 1 and "failures" not in run.entries()[bad]
    active = spark.createDataFrame([(run.entries()[bad]["submission"]["job"], "Active", 0, 0)], STATUS)
    assert I.outcomes_of(spark, run.store, active).count() == 0


def test_rows_above_the_cap_are_audited(spark, sf, run, tmp_path):
    assert run().overshoot == 0
    rows = [("b", f"k{k}", None, "UPDATE_METADATA", {"t": "1"}, str(k), datetime(2024, 1, 6, 0, k // 4), None, None, None) for k in range(12)]
    journal = spark.createDataFrame(rows, catalogue.journal(spark, sf).select("bucket", "key", "version_id", "record_type", "object_tags", "sequence_number", "record_timestamp", F.col("record_timestamp").alias("last_modified_date"), "storage_class", "is_delete_marker").schema)
    I.seed(run.store, ["b"], datetime(2024, 1, 5))
    out = I.run_interval(spark, journal, R.inline_rules(spark), run.store, lambda *_: I.SUBMITTED, str(tmp_path / "more"), G.Settings(row_cap=5), only=["b"])
    assert out.capped and out.overshoot == 3
