"""Capped batches as a stream: windows do not depend on when they are admitted, and a restart repeats none."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tagflow.operators import journal as J
from tagflow.sources.sinks import StateConflict
from tagflow.streaming import admission as A

DAY = dt.datetime(2024, 1, 1)
#: Seconds of the rows: runs of equal times, one of them longer than the cap.
AT = [0, 1, 1, 1, 2, 3, 4, 4, 4, 4, 4, 5, 6, 7, 8]


@pytest.fixture
def journal(spark):
    return spark.createDataFrame([(i, DAY + dt.timedelta(seconds=s, microseconds=7)) for i, s in enumerate(AT)] + [(99, None)], "id long, record_timestamp timestamp_ntz")


def chain(journal, cap):
    """Windows by the capped run applied again and again, each after the last one's boundary."""
    out, rest = [], journal.where("record_timestamp IS NOT NULL")
    while not rest.isEmpty():
        part = sorted(r.id for r in J.with_ties(rest, cap).collect())
        out.append(part)
        rest = rest.where(~F.col("id").isin(part))
    return out


def until(journal, seconds):
    return journal.where(F.col("record_timestamp") < F.lit(str(DAY + dt.timedelta(seconds=seconds))).cast("timestamp_ntz"))


@pytest.mark.parametrize("cap", [3, 100])
def test_windows_are_those_of_the_chain_however_they_are_admitted(spark, journal, tmp_path, cap):
    whole = chain(journal, cap)
    for name, cuts in (("once", []), ("often", [2, 5])):
        log = A.AdmissionLog(spark, str(tmp_path / name))
        for cut in cuts:
            log.admit(until(journal, cut), cap)
        log.admit(journal, cap, last=True)
        windows = log.windows()
        assert [sorted(r.id for r in A.between(journal, w["after"], w["until"]).collect()) for w in windows] == whole
        assert [(w["number"], w["rows"]) for w in windows] == [(k, len(x)) for k, x in enumerate(whole)]
        assert log.admit(journal, cap, last=True) == []


def test_a_restart_goes_on_after_the_last_window(spark, journal, tmp_path):
    log, seen = A.AdmissionLog(spark, str(tmp_path / "log")), []
    keep = lambda rows, w: seen.append((w["number"], sorted(r.id for r in rows.collect())))
    A.drained(log, journal, keep, str(tmp_path / "state"))
    assert seen == []
    whole = list(enumerate(chain(journal, 3)))
    log.admit(until(journal, 5), 3)
    A.drained(log, journal, keep, str(tmp_path / "state"))
    first = len(log.windows())
    assert 1 < first < len(whole) and seen == whole[:first]
    A.drained(log, journal, keep, str(tmp_path / "state"))
    log.admit(journal, 3, last=True)
    A.drained(log, journal, keep, str(tmp_path / "state"))
    assert seen == whole
    seen.clear()
    mark = log.windows()[1]["until"]
    A.drained(log, journal, keep, str(tmp_path / "other"), after=mark)
    assert seen == whole[2:]


def test_a_window_that_failed_is_handled_again(spark, journal, tmp_path):
    log, seen, tries = A.AdmissionLog(spark, str(tmp_path / "log")), [], []
    log.admit(journal, 3, last=True)

    def breaking(rows, w):
        tries.append(w["number"])
        if tries == [0, 1]:
            raise RuntimeError("the sink is away")
        seen.append((w["number"], sorted(r.id for r in rows.collect())))

    with pytest.raises(Exception):  # noqa: B017, PT011 - the stream ends with the sink's error
        A.drained(log, journal, breaking, str(tmp_path / "state"))
    A.drained(log, journal, breaking, str(tmp_path / "state"))
    assert seen == list(enumerate(chain(journal, 3)))
    assert tries == [0, 1, *range(1, len(seen))]


def test_two_writers_of_one_log(spark, journal, tmp_path, monkeypatch):
    log, other = A.AdmissionLog(spark, str(tmp_path)), A.AdmissionLog(spark, str(tmp_path))
    held = log._segments()
    other.admit(journal, 3)
    monkeypatch.setattr(log, "_segments", lambda: held)
    with pytest.raises(StateConflict):
        log.admit(journal, 3)
    empty = A.AdmissionLog(spark, str(tmp_path / "empty"))
    assert empty.admit(journal.where("false"), 3, last=True) == []
