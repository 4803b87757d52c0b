"""Report merges into the partitioned table of objects, report documents, and checkpoints laid over stored documents."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from tagflow.operators import reports as P
from tagflow.operators import state as S
from tagflow.sources import codecs as D
from tagflow.sources.items import ItemTable
from tagflow.sources.sinks import StateConflict, StateStore

SCHEMA = "bucket string, key string, version_id string, configs map<string,string>, state string, outcome string, tagged_at int"
ROWS = "job_id string, position int, bucket string, key string, version_id string, configs map<string,string>, tagged_at int"


def listed(df):
    return sorted(((r.bucket, r.key, r.version_id, dict(r.configs), r.state, r.outcome, r.tagged_at) for r in df.collect()), key=str)


def test_upsert_keeps_columns_and_other_configs(spark):
    items = spark.createDataFrame([("b", "k", None, {"a": "1", "c": "1"}, "RESOLVED", "FAILED", 5), ("b", "k", "", {"a": "1"}, "PENDING", None, None), ("b", "bare", None, None, "PENDING", None, 9)], SCHEMA)
    rows = spark.createDataFrame([("j", 2, "b", "k", None, {"a": "3"}, 8), ("j", 1, "b", "k", None, {"a": "2", "d": "2"}, 7), ("j", 1, "b", "new", "v", {"a": "2"}, 7), ("j", 1, "b", "bare", None, {"a": "2"}, 1), ("j", 1, "b", "empty", None, {}, 4)], ROWS)
    assert listed(S.upsert(items, rows, "position")) == sorted(
        [("b", "k", None, {"a": "3", "c": "1", "d": "2"}, "RESOLVED", "FAILED", 5), ("b", "k", "", {"a": "1"}, "PENDING", None, None), ("b", "new", "v", {"a": "2"}, "PENDING", None, 7), ("b", "bare", None, {"a": "2"}, "PENDING", None, 9), ("b", "empty", None, {}, "PENDING", None, 4)], key=str)


def test_merging_a_report_twice_changes_nothing(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    table = ItemTable(spark, store, str(tmp_path), SCHEMA, 16)
    assert table.items().collect() == []
    first = spark.createDataFrame([("j1", 1, "b", f"k{i}", None, {"a": "1"}, i) for i in range(40)], ROWS)
    assert table.merge(first, "position")
    held, document = listed(table.items()), store.read("items")
    assert len(held) == 40
    assert table.merge(first, "position") == []
    assert (listed(table.items()), store.read("items")) == (held, document)
    touched = table.merge(spark.createDataFrame([("j2", 1, "b", "k7", None, {"b": "2"}, 0)], ROWS))
    assert len(touched) == 1
    old, new = document[0]["parts"], store.read("items")[0]["parts"]
    assert [k for k in new if new[k] != old.get(k)] == [str(touched[0])]
    assert [x for x in listed(table.items()) if x not in held] == [("b", "k7", None, {"a": "1", "b": "2"}, "PENDING", None, 7)]
    assert sorted(r.job_id for r in table.merged_jobs().collect()) == ["j1", "j2"]


def test_a_merge_makes_its_rows_once(spark, tmp_path):
    table = ItemTable(spark, StateStore(spark, str(tmp_path / "state")), str(tmp_path), SCHEMA, 4)
    name = F.udf(lambda: str(uuid.uuid4()), "string").asNondeterministic()
    rows = spark.range(50).select(name().alias("job_id"), F.lit(1).alias("position"), F.lit("b").alias("bucket"), F.col("id").cast("string").alias("key"), F.lit(None).cast("string").alias("version_id"), F.lit(0).alias("tagged_at"))
    rows = rows.select("job_id", "position", "bucket", "key", "version_id", F.create_map(F.lit("c"), F.col("job_id")).alias("configs"), "tagged_at")
    table.merge(rows, "position")
    assert sorted(r.job_id for r in table.merged_jobs().collect()) == sorted(r.configs["c"] for r in table.items().collect())


def test_a_merge_beside_another_writer_is_refused(spark, tmp_path, monkeypatch):
    store = StateStore(spark, str(tmp_path / "state"))
    table = ItemTable(spark, store, str(tmp_path), SCHEMA, 4)
    rows = spark.createDataFrame([("j1", 1, "b", "k", None, {"a": "1"}, 1)], ROWS)
    read = store.read
    monkeypatch.setattr(store, "read", lambda name: (read(name)[0], 41))
    with pytest.raises(StateConflict):
        table.merge(rows)
    monkeypatch.undo()
    assert table.items().collect() == []


OBJECTS = "bucket string, key string, version_id string, rules array<string>, destinations array<string>, outcome string, tagged_at timestamp_ntz, last_modified timestamp_ntz"


def objects(spark):
    rows = [("b", f"k{i:03}", None, ["r2", "r1", "r2"] if i % 2 else ["r3"], None if i % 5 == 0 else ["d"], ["FAILED", "COMPLETE", None][i % 3], None, None) for i in range(30)]
    out = spark.createDataFrame(rows, OBJECTS)
    return out.withColumn("tagged_at", F.when(F.col("key") != "k001", F.expr("timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(0, 0, 0, int(substr(key, 2)) * 0.5)")))


def test_documents_have_members_in_order_and_groups_by_first_object(spark):
    (row,) = P.completion_documents(objects(spark)).collect()
    document = json.loads(row.document)
    assert list(document) == ["summary", "format_version", "source_bucket", "item_count", "outcome_counts", "groups"]
    assert (row.chunk, document["item_count"], document["format_version"]) == (0, 30, 2)
    assert document["outcome_counts"] == {"FAILED": 10, "COMPLETE": 10, "null": 10}
    groups = document["groups"]
    assert [(g["matched_rules"], g["destinations"]) for g in groups] == [(["r3"], []), (["r1", "r2"], ["d"]), (["r3"], ["d"]), (["r1", "r2"], [])]
    assert sum(g["count"] for g in groups) == 30
    assert list(groups[0]) == ["source_bucket", "matched_rules", "destinations", "count", "outcome_counts", "tagged_at_range"]
    assert groups[1]["tagged_at_range"] == ["2024-01-05T00:00:01.500000+00:00", "2024-01-05T00:00:14.500000+00:00"]
    assert groups[0]["tagged_at_range"][0] == "2024-01-05T00:00:00+00:00"


def test_documents_are_cut_between_groups(spark):
    left = spark.createDataFrame([("b", 3)], "bucket string, outstanding long")
    rows = P.completion_documents(objects(spark), left, budget=10).orderBy("chunk").collect()
    documents = [json.loads(r.document) for r in rows]
    assert [len(d["groups"]) for d in documents] == [1, 1, 1, 1]
    assert [d["item_count"] for d in documents] == [d["groups"][0]["count"] for d in documents]
    assert {d["outstanding"] for d in documents} == {3}
    assert all("3 objects remain in tracking." in d["summary"] for d in documents)


def test_overlay_keeps_every_other_byte(spark):
    patch = '{"mark": "new", "lease": {"id": 7}}'
    cases = {
        '{"a":1.50,\n "mark":"old","deep":{"mark":"in"}}': '{"a":1.50,\n "mark":"new","deep":{"mark":"in"}, "lease": {"id": 7}}',
        '{"deep": [{"lease": 1}], "text": "\\"mark\\": \\"x\\"}" }': '{"deep": [{"lease": 1}], "text": "\\"mark\\": \\"x\\"}", "mark": "new", "lease": {"id": 7} }',
        '{"lease": null, "m\\u0061rk": 1e5}': '{"lease": {"id": 7}, "m\\u0061rk": "new"}',
        " { } ": ' {"mark": "new", "lease": {"id": 7} } ',
        "[1]": None,
        '{"mark": ': None,
        "{} x": None,
        None: patch,
    }
    df = spark.createDataFrame([(k,) for k in cases], "document string")
    got = {r.document: r.out for r in df.select("document", D.with_members(F.col("document"), F.lit(patch)).alias("out")).collect()}
    assert got == cases
