"""Stored state, leases, buckets that fail, tracking intervals, report files."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tagflow.functions import columns as C
from tagflow.operators import journal as J
from tagflow.operators import rules as R
from tagflow.operators import settings as G
from tagflow.operators import state as S
from tagflow.plans import catalogue
from tagflow.plans import interval as I
from tagflow.plans import tracking as K
from tagflow.sources import codecs as D
from tagflow.sources import reports as Q
from tagflow.sources.journal import SCHEMA, read_journal
from tagflow.sources.sinks import Files, StateConflict, StateStore, publish, publish_parts

START = datetime(2024, 1, 5)
BUCKETS = ["lake-0", "lake-1", "lake-2"]


@pytest.fixture
def store(spark, tmp_path):
    out = StateStore(spark, str(tmp_path / "state"))
    I.seed(out, BUCKETS, START)
    return out


def test_a_crash_leaves_no_part_of_a_document(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    assert store.write("a.b", {"x": 1}, None) == 1
    (tmp_path / "s" / ".a.b.2.json.draft").write_text("{bro")
    assert store.read("a.b") == ({"x": 1}, 1)
    assert store.write("a.b", {"x": "ü"}, 1) == 2 and store.read("a.b") == ({"x": "ü"}, 2)
    with pytest.raises(FileExistsError):
        Files(spark, str(tmp_path / "s")).write("a.b.2.json", "{}")
    with pytest.raises(StateConflict):
        store.write("a.b", {}, 1)
    assert store.read("a.b") == ({"x": "ü"}, 2) and store.read("a") == (None, None)


def test_an_update_is_tried_again_after_another_writer(spark, tmp_path):
    store, raced = StateStore(spark, str(tmp_path / "s")), []

    def change(document):
        if len(raced) < 2:
            raced.append(store.write("n", {"other": len(raced)}, store.read("n")[1]))
        return (document or {}) | {"mine": True}

    store.update("n", change)
    assert store.read("n")[0] == {"other": 1, "mine": True}
    raced.clear()
    with pytest.raises(StateConflict):
        store.update("n", lambda d: raced.append(0) or store.write("n", {}, store.read("n")[1]) and {})
    assert len(raced) == 5


def interval(spark, sf, store, tmp_path, submit=lambda *_: I.SUBMITTED, journal=None, only=None):
    journal = catalogue.journal(spark, sf) if journal is None else journal
    return I.run_interval(spark, journal, R.inline_rules(spark), store, submit, str(tmp_path / "runs"), G.Settings(), only=only)


def test_lease_is_held_while_submitting_and_given_up_on_every_way_out(spark, sf, store, tmp_path, monkeypatch):
    seen = []

    def submit(bucket, envelope, token):
        seen.append((store.read(I.STATE)[0]["buckets"][bucket]["lease"]["mark"], token))
        raise OSError("no answer")

    interval(spark, sf, store, tmp_path, submit)
    assert seen and all(mark > START.isoformat() for mark, _ in seen)
    assert not any("lease" in e for e in store.read(I.STATE)[0]["buckets"].values())
    first = sorted(t for _, t in seen)
    seen.clear()
    interval(spark, sf, store, tmp_path, submit)
    assert sorted(t for _, t in seen) == first
    before = store.read(I.STATE)[0]
    monkeypatch.setattr(I, "write_manifests", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        interval(spark, sf, store, tmp_path)
    assert store.read(I.STATE)[0] == before


def test_anothers_lease_holds_back_what_lies_up_to_its_mark(spark, sf, store, tmp_path):
    document, version = store.read(I.STATE)
    far = {"id": "x", "mark": "2024-12-31T00:00:00", "acquired_at": "2024-01-06T00:00:00"}
    broken = [far | {"mark": "9999-01-01T00:00:00"}, far | {"id": 7}, {"mark": far["mark"]}, "x", far | {"acquired_at": "soon"}]
    assert [I.lease_mark({"lease": x}) for x in [far, *broken, None]] == [datetime(2024, 12, 31)] + [None] * 6
    document["buckets"]["lake-0"]["lease"] = far
    document["buckets"]["lake-1"]["lease"] = broken[0]
    store.write(I.STATE, document, version)
    out = interval(spark, sf, store, tmp_path)
    assert "lake-0" not in out.answers and "lake-1" in out.answers
    left = store.read(I.STATE)[0]["buckets"]
    assert left["lake-0"]["lease"] == far and "lease" not in left["lake-1"]


def test_a_bucket_that_cannot_be_read_stands_alone(spark, sf, store, tmp_path):
    good = catalogue.journal(spark, sf)
    bad = F.when(F.col("bucket") == "lake-1", F.raise_error(F.lit("cannot be read"))).otherwise(F.col("key"))
    journal = good.withColumn("key", bad.cast("string"))
    out = I.isolated(lambda some: interval(spark, sf, store, tmp_path, journal=journal, only=some), BUCKETS)
    assert set(out.errors) == {"lake-1"} and {"lake-0", "lake-2"} >= set(out.answers) and out.answers
    assert store.read(I.STATE)[0]["buckets"]["lake-1"] == {"watermark": START.isoformat()}


def test_envelope_is_written_after_its_checksum(spark, sf, store, tmp_path):
    out = interval(spark, sf, store, tmp_path)
    bucket = next(iter(out.manifests))
    found = next((tmp_path / "runs").glob(f"*/envelopes/{bucket}/manifest.json"))
    envelope = json.loads(found.read_text())
    assert [f["key"] for f in envelope["files"]] == [f["key"] for f in out.manifests[bucket]["files"]]
    assert (found.parent / "manifest.checksum").read_text() == out.manifests[bucket]["checksum"]


# ---------------------------------------------------------------- tracking

T0 = datetime(2024, 1, 1)


def item(key, state="PENDING", at=T0, confirmed=True, version="v", outcome=None, config="c"):
    return ("b", key, version, {config: ("j", at, confirmed)}, state, outcome, None, at, ["r"], ["d"])


def track(spark, items, statuses, tmp_path, scans=(("c", T0 + timedelta(1), 0),), publish_=None, **settings):
    sent = []
    items = spark.createDataFrame(items, K.ITEMS) if isinstance(items, list) else items
    status = spark.createDataFrame(statuses, "bucket string, key string, version_id string, kind string, value string")
    scan = spark.createDataFrame(list(scans), "config_id string, last_scan_at timestamp_ntz, last_scan_match_count long")
    out = K.run_tracking(items, scan, status, publish_ or (lambda r: sent.extend(r.collect())), str(tmp_path), G.Settings(**settings), catalogue.ntz(T0 + timedelta(3)))
    return out, sent, {(r.key, r.version_id): (r.state, r.outcome) for r in out.items.collect()}


def test_tracking_checks_resolves_publishes_and_forgets(spark, tmp_path):
    items = [item("done"), item("done", version=None), item("bad"), item("wait"), item("open", confirmed=False), item("old", at=T0 - timedelta(30)), item("loud", config="x"), item("lost"), item("gone")]
    status = [("b", "done", "v", "HEADER_VALUE", "COMPLETED"), ("b", "done", None, "HEADER_ABSENT", None), ("b", "bad", "v", "HEADER_VALUE", "FAILED"), ("b", "wait", "v", "HEADER_VALUE", "PENDING"), ("b", "loud", "v", "HEADER_VALUE", "COMPLETED"), ("b", "lost", "v", "CHECK_FAILED", None), ("b", "gone", "v", "OBJECT_GONE", None)]
    out, sent, left = track(spark, items, status, tmp_path)
    assert (out.checked, out.resolved, out.published) == (8, 6, 5)
    assert left == {("wait", "v"): ("PENDING", None), ("open", "v"): ("PENDING", None), ("loud", "v"): ("RESOLVED", "COMPLETE"), ("lost", "v"): ("PENDING", None)}
    assert len(sent) == 1 and sent[0].item_count == 5 and "4 objects remain in tracking" in sent[0].summary


def test_a_report_that_does_not_go_out_leaves_its_objects(spark, tmp_path):
    status = [("b", "k", "v", "HEADER_VALUE", "COMPLETED")]
    out, _, left = track(spark, [item("k")], status, tmp_path, publish_=lambda r: 1 / 0)
    assert out.published == 0 and left == {("k", "v"): ("RESOLVED", "COMPLETE")}
    out, sent, left = track(spark, out.items, [], tmp_path)
    assert out.published == 1 and len(sent) == 1 and not left


def test_oldest_candidates_come_first_and_expiry_may_be_off(spark, tmp_path):
    items = [item(f"k{k}", at=T0 - timedelta(20 - k)) for k in range(5)]
    out, _, left = track(spark, items, [], tmp_path, check_batch=2)
    assert out.checked == 2 and {k for k, _ in left} == {"k2", "k3", "k4"}
    out, _, left = track(spark, items, [], tmp_path, tracking_ttl_s=0)
    assert out.resolved == 0 and len(left) == 5


# ---------------------------------------------------------------- files and codecs

def test_report_files(spark, tmp_path):
    folder = tmp_path / "r"
    assert Q.read_reports(spark, str(folder)).count() == 0 and not Q.report_exists(spark, str(folder))
    (folder / "job-1" / "results").mkdir(parents=True)
    (folder / "job-1" / "manifest.json").write_text("{}")
    (folder / "job-1" / "side.csv").write_text("x,y\n")
    rows = ['b,a%2520b%2Cc,v1,succeeded,200,,Successful', 'b,p+q,,failed,AccessDenied,403,"no, ""really"""', '"b","line%0Aend",null,failed,404,NoSuchKey,', 'b,"in,quotes",v', "b,%zz,v2,failed,,,"]
    (folder / "job-1" / "results" / "x.csv").write_text("\n".join(rows) + "\n")
    got = {r.key: tuple(r)[2:7] for r in Q.read_reports(spark, str(folder)).collect()}
    assert got == {
        "a%20b,c": ("v1", "succeeded", "200", None, "Successful"),
        "p+q": (None, "failed", "403", "AccessDenied", 'no, "really"'),
        "line\nend": (None, "failed", "404", "NoSuchKey", None),
        "in,quotes": ("v", None, None, None, None),
        "%zz": ("v2", "failed", None, None, None),
    }
    assert Q.report_exists(spark, str(folder))


def test_stored_documents_keep_what_others_wrote(spark):
    document = '{"source_bucket": "b", "last_processed_watermark" : "", "other": {"last": 1}}'
    df = spark.createDataFrame([("b", document)], "bucket string, document string")
    new = df.select("bucket", D.overlaid(F.col("document"), F.lit("2024-01-01T00:00:00.000000Z")).alias("document"))
    assert json.loads(new.first().document) == {"source_bucket": "b", "last_processed_watermark": "2024-01-01T00:00:00.000000Z", "other": {"last": 1}}
    row = D.decoded(df, F.current_timestamp()).first()
    assert (row.problem, row.watermark, row.lease, row.lease_discarded, row.processed_window, row.completion_items) == (None, "", None, False, [], {})
    window = '{"source_bucket": "b", "last_processed_watermark": "", "lease": null, "processed_window": [{"logical_operation_id": "z", "watermark": "w"}, {"logical_operation_id": "a", "watermark": "w"}], "submission_records": [{"job_id": "j"}]}'
    row = D.decoded(spark.createDataFrame([("b", window)], "bucket string, document string"), F.current_timestamp())
    again = json.loads(D.encoded(row).first().document)
    assert [x["logical_operation_id"] for x in again["processed_window"]] == ["a", "z"] and again["submission_records"] == [{"job_id": "j"}]


def test_what_is_decoded_again_needs_no_join(spark, sf):
    df = catalogue.queries()["checkpoint_decode"](spark, sf)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    rows = spark.createDataFrame([("b", "[1]", 7), ("b", '{"source_bucket": "b", "last_processed_watermark": ""}', 8)], "bucket string, document string, n int")
    read = D.decoded(rows, F.current_timestamp(), "n")
    assert sorted((r.n, r.problem) for r in read.collect()) == [(7, "not an object"), (8, None)]
    assert sorted((r.n, r.document is None) for r in D.encoded(read, "n").collect()) == [(7, True), (8, False)]
    assert D.encoded(read).count() == 1


def test_manifest_rows_are_parsed_back(spark):
    rows = [("b", "a,b\nc d+e%20f/ü", None), ("b", "k", "v,1"[:1]), ("b", "", "x"), ("b", "plain", "")]
    df = spark.createDataFrame(rows, "bucket string, key string, version_id string")
    out = df.select(C.manifest_row(F.col("bucket"), F.col("key"), F.col("version_id")).alias("row")).select(*C.parse_manifest_row(F.col("row"))).collect()
    assert sorted(map(tuple, out), key=str) == sorted(((b, k, v or None) for b, k, v in rows), key=str)


def test_event_times_and_marks(spark):
    texts = ["2024-11-15 10:20:30.123 UTC", "2024-11-15 10:20:30 UTC", "2024-11-15 10:20:30.123456", "2024-11-15 10:20:30", "2024-11-15T10:20:30.123Z", "2024-11-15T10:20:30Z", "", "junk", "2024-11-15"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(C.parse_event_time(F.col("t")).isNotNull()).collect()]
    assert got == [True] * 6 + [False] * 3
    marks = spark.createDataFrame([("2024-01-01T00:00:00.000001Z",), ("",)], "m string").select(C.watermark(C.parse_watermark(F.col("m")))).collect()
    assert [m[0] for m in marks] == ["2024-01-01T00:00:00.000001Z", ""]


def test_row_cap_boundary_counts_ties_and_nulls(spark):
    times = [datetime(2024, 1, 1, h, 0, s, u) for h, s, u in [(0, 0, 0), (0, 0, 0), (0, 0, 5), (0, 3, 0), (5, 0, 0), (5, 0, 0)]]
    df = spark.createDataFrame([(t,) for t in [*times, None]], "record_timestamp timestamp_ntz")
    assert [[r[0] for r in J.row_cap_boundary(df, n).collect()] for n in range(1, 8)] == [[t] for t in times] + [[]]
    assert J.with_ties(df, 5).count() == 6 and J.with_ties(df, 1).count() == 2


def test_chunks(spark):
    rows = [("a", k, n) for k, n in enumerate([5, 5, 20, 1, 1])] + [("b", 0, 99)]
    got = S.chunked_groups(spark.createDataFrame(rows, "bucket string, k int, size int"), ["k"], 10).orderBy("bucket", "k").collect()
    assert [(r.bucket, r.chunk) for r in got] == [("a", 0), ("a", 0), ("a", 1), ("a", 2), ("a", 2), ("b", 0)]


def test_sizes_and_names():
    assert [G.row_ceiling(m) for m in (0, 1024, 1536, 2000, 5120, 99999)] == [250_000, 250_000, 250_000, 500_000, 1_000_000, 2_500_000]
    G.check_row_cap(500_000, 2048)
    with pytest.raises(G.ConfigError):
        G.check_row_cap(500_001, 2048)
    assert [G.interval_text(m) for m in (60, 30, 120, 90)] == ["1h", "30m", "2h", "90m"]


def test_journal_source_and_sinks(spark, tmp_path):
    assert read_journal(spark, str(tmp_path / "none")) is None
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "j"))
    assert read_journal(spark, str(tmp_path / "j")).columns[:2] == ["bucket", "key"]
    publish(spark.range(3), str(tmp_path), "metrics")
    publish_parts(spark.range(25).coalesce(1), str(tmp_path), "parts", 10)
    assert spark.read.json(str(tmp_path / "metrics")).count() == 3 and len(list((tmp_path / "parts").glob("*.json"))) == 3
