"""Batches are handed over once, wherever a run breaks off; acknowledged identities stay out until their time has passed."""

import datetime as dt

import pytest

from tagflow.sources.sinks import StateStore
from tagflow.streaming import ledger as L
from tagflow.streaming import processed as P


class Crash(RuntimeError):
    pass


@pytest.mark.parametrize("where", ["before", "between", "after"])
def test_a_crash_leaves_one_submission(spark, tmp_path, where):
    spark.range(6).repartition(1).write.parquet(str(tmp_path / "in"))
    store, sink = StateStore(spark, str(tmp_path / "ledger")), L.JobSink(spark, str(tmp_path / "jobs"))
    ledger = L.Ledger(store, "journal")
    tries = []

    class Breaking:
        """A sink that stops the first run before or after it has taken the submission."""

        def submit(self, token, record):
            tries.append(token)
            if where == "before" and len(tries) == 1:
                raise Crash
            taken = sink.submit(token, record)
            if where == "between" and len(tries) == 1:
                raise Crash
            return taken

    run = L.handing_over(ledger, Breaking(), str(tmp_path / "batches"), lambda rows: {"rows": rows.count()})

    def once(rows, number):
        run(rows, number)
        if where == "after" and not (tmp_path / "crashed").exists():
            (tmp_path / "crashed").touch()
            raise Crash

    def start():
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        return stream.writeStream.foreachBatch(once).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()

    with pytest.raises(Exception):  # noqa: B017, PT011 - the stream ends with the crash
        start().awaitTermination()
    start().awaitTermination()
    assert [x["rows"] for x in sink.submissions()] == [6]
    assert (ledger.last(), ledger.state()) == (0, {"submitted": 1})
    assert len(tries) == (1 if where == "after" else 2)


def test_a_batch_is_taken_once_and_in_order(spark, tmp_path):
    ledger = L.Ledger(StateStore(spark, str(tmp_path)), "x")
    seen = []
    work = lambda state, token: seen.append(token) or {"n": state.get("n", 0) + 1}
    assert [ledger.take(k, work) for k in (0, 0, 1, 0, 1)] == [True, False, True, False, False]
    assert ledger.state() == {"n": 2}
    assert len(set(seen)) == 2


JOURNAL = "bucket string, key string, version_id string, object_tags map<string,string>, sequence_number string, record_timestamp timestamp_ntz"


def ops(spark, *rows):
    return P.operations(spark.createDataFrame([("b", k, None, {"t": "1"}, s, dt.datetime(2024, 1, d, h, 0, 0, 7)) for k, s, d, h in rows], JOURNAL))


def test_identities_come_through_until_they_are_acknowledged(spark, tmp_path):
    stream = P.Journaled(spark, str(tmp_path), JOURNAL, "1 day")
    got = lambda: sorted((r.key, r.sequence_number) for r in stream.advance().collect())
    stream.append(ops(spark, ("x", "1", 5, 1), ("x", "2", 5, 0), ("y", "1", 5, 2)))
    first = [("x", "2"), ("y", "1")]
    assert got() == first
    lids = {r.key: r.lid for r in spark.read.schema(stream.advance().schema).parquet(f"{tmp_path}/rows").collect()}
    # not submitted: a second delivery comes through again
    stream.append(ops(spark, ("y", "1", 5, 2)))
    assert got() == sorted([*first, ("y", "1")])
    stream.append(P.acknowledgements(spark.createDataFrame([(lids["y"], dt.datetime(2024, 1, 5, 2, 0, 0, 7))], "lid string, mark timestamp_ntz")))
    stream.append(ops(spark, ("y", "1", 5, 2)))
    assert got() == sorted([*first, ("y", "1")])
    # a later operation of the identity is a new one, and what lies before the watermark is dropped
    stream.append(ops(spark, ("y", "7", 8, 0)))
    whole = sorted([*first, ("y", "1"), ("y", "7")])
    assert got() == whole
    stream.append(ops(spark, ("x", "9", 5, 3), ("z", "1", 6, 23)))
    assert got() == whole


def test_marks_of_many_identities_are_one_value_of_state(spark, tmp_path, monkeypatch):
    """Calls into the state grow with shards, not with identities; marks of one shard are kept apart and leave one by one."""
    monkeypatch.setattr(P.unprocessed, "__defaults__", (1,))
    stream = P.Journaled(spark, str(tmp_path), JOURNAL, "1 day")
    got = lambda: sorted((r.key, r.sequence_number) for r in stream.advance().collect())
    times = {f"k{n}": (5, n) for n in range(20)}
    stream.append(ops(spark, *((k, "1", d, h) for k, (d, h) in times.items())))
    first = got()
    assert first == sorted((k, "1") for k in times)
    lids = {r.key: r.lid for r in spark.read.schema(stream.advance().schema).parquet(f"{tmp_path}/rows").collect()}
    marks = [(lids[k], dt.datetime(2024, 1, d, h, 0, 0, 7)) for k, (d, h) in times.items() if k != "k3"]
    stream.append(P.acknowledgements(spark.createDataFrame(marks, "lid string, mark timestamp_ntz")))
    # in one batch with their acknowledgements; k3 has none, k4 has a later operation
    stream.append(ops(spark, *((k, "1", d, h) for k, (d, h) in times.items()), ("k4", "2", 5, 5)))
    second = sorted([*first, ("k3", "1"), ("k4", "2")])
    assert got() == second
    # the watermark passes half of the marks; the others hold
    stream.append(ops(spark, ("late", "1", 6, 10)))
    third = sorted([*second, ("late", "1")])
    assert got() == third
    stream.append(ops(spark, *((k, "3", d, h) for k, (d, h) in times.items())))
    assert got() == third
    state = spark.read.format("statestore").option("path", f"{tmp_path}/state").option("stateVarName", "marks").load()
    assert [len(P._unpacked(bytes(r.value.marks))) for r in state.select("value").collect()] == [10]
