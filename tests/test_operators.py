"""Edge cases of the journal, rule, manifest and state operators."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tagflow.functions import columns as C
from tagflow.operators import journal as J
from tagflow.operators import manifest as M
from tagflow.operators import rules as R
from tagflow.operators import state as S

T0 = datetime(2024, 1, 10)
OPS = "bucket string, key string, version_id string, object_tags map<string,string>, sequence_number string, record_timestamp timestamp_ntz, storage_class string"


def op(key="k", version=None, tags=None, seq="1", at=T0, storage=None):
    return ("b", key, version, {"t": "1"} if tags is None else tags, seq, at, storage)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), OPS)


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


def test_latest_takes_the_highest_sequence_and_parts_versions_and_tags(spark):
    rows = J.latest(frame(spark, op(seq="1"), op(seq="2", at=T0 - timedelta(1)), op(version=""), op(version="v1"), op(tags={"t": "1", "u": "2"}))).collect()
    assert len(rows) == 4
    assert max(r.deliveries for r in rows) == 2
    assert [r.sequence_number for r in rows if r.deliveries == 2] == ["2"]


def test_identity_does_not_depend_on_the_order_of_tags(spark):
    rows = J.latest(frame(spark, op(tags={"a": "1", "b": "2"}), op(tags={"b": "2", "a": "1"}, seq="2")))
    assert rows.count() == 1


def test_validity_names_the_reason(spark):
    got = {r.error_reason for r in J.validity(frame(spark, op(), op(key=""), op(tags={}))).collect()}
    assert got == {None, "empty key", "no tags"}


def test_eligibility_bounds(spark):
    ops = J.latest(frame(spark, op("at", at=T0), op("after", at=T0 + timedelta(seconds=1)), op("start", at=T0 - timedelta(hours=2)), op("inside", at=T0 - timedelta(hours=1)), op("seen", at=T0 - timedelta(minutes=5))))
    state = spark.createDataFrame([("b", T0, None)], "bucket string, watermark timestamp_ntz, lease_mark timestamp_ntz")
    seen = ops.where("key = 'seen'").select("lid")
    keys = lambda lookback: {r.key for r in J.eligible(ops, state, seen, lookback).collect()}
    assert keys(7200) == {"at", "after", "inside"}
    assert keys(0) == {"after"}


def test_archive_record_replaces_the_tag_record(spark):
    ops = J.latest(frame(spark, op(seq="1"), op(seq="2", storage=" deep_archive ")))
    assert J.without_archived(ops).count() == 0


def test_archived_values(spark):
    keep = [None, "STANDARD", "GLACIER_IR", "INTELLIGENT_TIERING"]
    gone = ["GLACIER", " glacier ", "Deep_Archive"]
    rows = spark.createDataFrame([(x,) for x in keep + gone], "s string").select("s", C.is_archived(F.col("s")).alias("a")).collect()
    assert [r.s for r in rows if not r.a] == keep


def test_ties_at_the_cap_stay(spark):
    ops = frame(spark, op("a"), op("b", at=T0 + timedelta(1)), op("c", at=T0 + timedelta(1)), op("d", at=T0 + timedelta(2)))
    assert {r.key for r in J.with_ties(ops, 2).collect()} == {"a", "b", "c"}
    assert J.with_ties(ops, 9).count() == 4


def test_matching_needs_all_tags_and_the_prefix(spark):
    rules = spark.createDataFrame(
        [("b", "c", "all", {"t": "1", "u": "2"}, "arn", None), ("b", "c", "pre", {"t": "1"}, "", "x/"), ("b", "c", "any", {"t": "1"}, "arn2", None)], R.SCHEMA
    )
    ops = J.latest(frame(spark, op("x/1", tags={"t": "1", "u": "2"}), op("y/1", tags={"t": "1"}), op("z", tags={"t": "3"})))
    got = {(r.key, r.rule_id) for r in R.match(ops, rules).collect()}
    assert got == {("x/1", "all"), ("x/1", "pre"), ("x/1", "any"), ("y/1", "any")}
    assert {(r.key, r.rule_id) for r in R.match_by_tags(ops, rules).collect()} == got
    assert {tuple(r.destinations) for r in R.grouped(R.match(ops, rules)).collect()} == {("arn", "arn2"), ("arn2",)}


def test_predicate_without_rules_is_false(spark):
    assert frame(spark, op()).where(R.predicate([])).count() == 0
    assert frame(spark, op()).where(R.predicate([{"tag_filter": {}, "key_prefix": None}])).count() == 1


def test_deletes_are_null_safe(spark):
    manifest = spark.createDataFrame([("b", "k", None), ("b", "k2", "v1")], "bucket string, key string, version_id string")
    gone = lambda *rows: M.without_deleted(manifest, spark.createDataFrame(list(rows), manifest.schema)).count()
    assert gone(("b", "k", "v1")) == 2
    assert gone(("b", "k2", None)) == 2
    assert gone(("b", "k", None), ("b", "k2", "v1")) == 0


def test_first_version_wins(spark):
    rules = spark.createDataFrame([("b", "c", "r", {"t": "1"}, "arn:aws:s3:::d", None)], R.SCHEMA)
    ops = J.latest(frame(spark, op(version="v2", at=T0 + timedelta(1)), op(version=None, at=T0)))
    row = M.union(R.match(ops, rules)).first()
    assert (row.version_id, row.rules, row.destinations) == (None, ["r"], ["d"])


def test_key_functions(spark):
    keys = ["a,b c\n+d%20", "日本/ü~*", "plain", "100%"]
    rows = spark.createDataFrame([(k,) for k in keys], "k string")
    assert [r.x for r in rows.select(C.decode_key(C.encode_key(F.col("k"))).alias("x")).collect()] == keys
    assert one(spark, C.decode_key(F.col("k")), k="100%zz+") == "100%zz+"
    assert one(spark, C.bucket_of_arn(F.col("k")), k="arn:aws:s3:::x") == "x"
    assert one(spark, C.manifest_row(F.col("b"), F.col("k"), F.col("v")), b="b", k="a b", v=None) == "b,a%20b,null"


def test_event_times(spark):
    good = ["2024-11-15 10:00:00.123456 UTC", "2024-11-15 10:00:00 UTC", "2024-11-15 10:00:00.123", "2024-11-15 10:00:00", "2024-11-15T10:00:00.123456Z", "2024-11-15T10:00:00Z"]
    rows = spark.createDataFrame([(x,) for x in [*good, "2024-11-15", "", "junk"]], "t string")
    got = [r.x is not None for r in rows.select(C.parse_event_time(F.col("t")).alias("x")).collect()]
    assert got == [True] * 6 + [False] * 3


def test_report_columns_in_either_order(spark):
    rows = spark.createDataFrame([("200", ""), ("AccessDenied", "403"), ("", ""), ("404", "500")], "a string, b string")
    status, code = C.status_and_error(F.col("a"), F.col("b"))
    assert [tuple(r) for r in rows.select(status, code).collect()] == [("200", None), ("403", "AccessDenied"), (None, None), ("404", "500")]


def test_recovery(spark):
    rows = [("b", "Complete", 0, 2, 0, "2024"), ("b", "Complete", 1, 9, 7, "2020"), ("b", "Failed", None, None, 2, ""), ("b", "Cancelled", 0, 0, 1, "2023")]
    plan = S.recovery_plan(spark.createDataFrame(rows, "bucket string, status string, tasks_succeeded long, tasks_failed long, consecutive_failures int, watermark_low string"), 3).first()
    assert (plan.consecutive_failures, plan.rollback_to, plan.skipped_empty, plan.disable) == (3, "2023", 1, True)


def test_watermarks_never_go_back(spark):
    state = spark.createDataFrame([("b", T0)], "bucket string, watermark timestamp_ntz")
    high = spark.createDataFrame([("b", T0 - timedelta(1))], "bucket string, high_water_mark timestamp_ntz")
    sent = spark.createDataFrame([("b",)], "bucket string")
    assert S.advance(state, high, sent).first().watermark == T0
    later = high.withColumn("high_water_mark", F.lit(T0 + timedelta(1)).cast("timestamp_ntz"))
    assert S.advance(state, later, sent.where("false")).first().watermark == T0
    assert S.advance(state, later, sent).first().watermark == T0 + timedelta(1)


def test_sinks(spark, tmp_path):
    from tagflow.sources import sinks

    rows = spark.createDataFrame([("b", "b,k,null"), ("b", "b,a,v1")], "bucket string, row string")
    found = sinks.write_manifests(rows, str(tmp_path / "m"), 10)["b"]
    assert found["object_count"] == 2
    sinks.write_envelope(spark, str(tmp_path / "e"), "b", "dest", 5, found["files"])
    assert '"creationTimestamp": "5"' in (tmp_path / "e" / "manifest.json").read_text()
    store = sinks.StateStore(spark, str(tmp_path / "s"))
    v1 = store.write("b", {"watermark": ""}, None)
    assert store.read("b") == ({"watermark": ""}, v1)
    v2 = store.write("b", {"watermark": "x"}, v1)
    import pytest

    with pytest.raises(sinks.StateConflict):
        store.write("b", {}, v1)
    assert v2 == v1 + 1 and store.read("none") == (None, None)
