"""The journal as a stream whose batches end by rows: its offset is a time mark, and a batch holds the rows up to the next one.

Spark's file sources admit whole files or bytes, and a journal's cap counts rows and never parts rows of one time. So the cap is applied
by a Spark job over counts by time (`AdmissionLog.admit`), which closes windows and puts them into a log; the stream source hands
on one window a batch, and the batch scans the journal between two marks, which the scan sees as filters. What goes through the
source is one small row for each window; journal rows go from the table to the batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from tagflow.operators.journal import capped_windows
from tagflow.sources.sinks import Files, StateConflict

SCHEMA = "number long, after string, until string, rows long"


def _name(segment: int) -> str:
    return f"segment-{segment:012d}.json"


def _literal(mark: str) -> F.Column:
    return F.lit(mark.replace("T", " ")).cast("timestamp_ntz")


def between(journal: DataFrame, after: str | None, until: str) -> DataFrame:
    """Journal rows of a window; marks are ISO times, and no `after` starts at the first row."""
    rows = journal.where(F.col("record_timestamp") <= _literal(until))
    return rows if after is None else rows.where(F.col("record_timestamp") > _literal(after))


class AdmissionLog:
    """Closed windows in segments, one for each admission that closed any; a segment is written whole, under a name of its own."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.files = Files(spark, self.folder)

    def _segments(self) -> list[str]:
        return sorted(n for n in self.files.names() if n.startswith("segment-"))

    def windows(self) -> list[dict]:
        return [w for n in self._segments() for w in json.loads(self.files.read(n))]

    def admit(self, settled: DataFrame, cap: int, last: bool = False) -> list[dict]:
        """Close the windows of `cap` or more rows that the journal holds past the last window, and log them; returns them.

        `settled` is the journal up to a time before which no row of a new time comes any more; rows that come later with a time
        in a closed window are late ones, which the lookback takes in. What is short of the cap waits for the next
        admission, so windows are the same however often one is made; `last` closes it too. Another writer's admission in
        between raises StateConflict. One row for each window, so for `cap` rows, reaches the driver.
        """
        names = self._segments()
        known = json.loads(self.files.read(names[-1]))[-1] if names else {"number": -1, "until": None}
        fresh = settled if known["until"] is None else settled.where(F.col("record_timestamp") > _literal(known["until"]))
        found = capped_windows(fresh, cap)
        found = found if last else found.where(F.col("rows") >= cap)
        out, after = [], known["until"]
        for r in found.orderBy("batch").collect():
            until = r.until.isoformat()
            out.append({"number": known["number"] + 1 + r.batch, "after": after, "until": until, "rows": r.rows})
            after = until
        if out:
            try:
                self.files.write(_name(len(names)), json.dumps(out))
            except FileExistsError as e:
                raise StateConflict(self.folder) from e
        return out


class _Windows(SimpleDataSourceStreamReader):
    """Offsets are a mark (the end of the last window read) and the place of the next window in the log."""

    def __init__(self, folder: str, after: str | None) -> None:
        self.folder, self.after = folder, after

    def initialOffset(self) -> dict:  # noqa: N802
        """The first window, or with `after` the first that ends later than that mark."""
        at = {"mark": None, "segment": 0, "window": 0}
        while self.after is not None:
            window, following = self._next(at)
            if window is None or datetime.fromisoformat(window["until"]) > datetime.fromisoformat(self.after):
                break
            at = following
        return at

    def _next(self, at: dict) -> tuple[dict | None, dict]:
        """The window at an offset and the offset after it; none, and the same offset, where it is not logged yet."""
        for segment, window in ((at["segment"], at["window"]), (at["segment"] + 1, 0)):
            held = self._segment(segment)
            if held is None:
                return None, at
            if window < len(held):
                return held[window], {"mark": held[window]["until"], "segment": segment, "window": window + 1}
        return None, at

    def _segment(self, number: int) -> list[dict] | None:
        files, path = fs.FileSystem.from_uri(self.folder) if "://" in self.folder or self.folder.startswith("file:") else (fs.LocalFileSystem(), self.folder)
        name = f"{path}/{_name(number)}"
        if files.get_file_info(name).type != fs.FileType.File:
            return None
        with files.open_input_stream(name) as stream:
            return json.loads(stream.read())

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        window, end = self._next(start)
        return iter([] if window is None else [self._row(window)]), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        """The windows of a batch that is run again."""
        at = start
        while at != end:
            window, at = self._next(at)
            if window is None:
                raise ValueError(f"the log in {self.folder} lacks a window that a batch has read")
            yield self._row(window)

    @staticmethod
    def _row(window: dict) -> tuple:
        return window["number"], window["after"], window["until"], window["rows"]


class AdmittedWindows(DataSource):
    """Stream source `admitted_windows`: one row (SCHEMA) a batch. Options: `path` of the log, and `after`, a mark to start from."""

    @classmethod
    def name(cls) -> str:
        return "admitted_windows"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> _Windows:  # noqa: N802
        return _Windows(self.options["path"], self.options.get("after"))


Handle = Callable[[DataFrame, dict], None]


def started(log: AdmissionLog, journal: DataFrame, handle: Handle, checkpoint: str, after: str | None = None) -> StreamingQuery:
    """A running stream: `handle(rows, window)` is called for each window of the log in order, with the journal's rows in it.

    The checkpoint holds the mark; after a failure the last window may be handled again, under the same number.
    """
    log.spark.dataSource.register(AdmittedWindows)
    reader = log.spark.readStream.format("admitted_windows").option("path", log.folder)
    windows = (reader if after is None else reader.option("after", after)).load()

    def run(batch: DataFrame, _: int) -> None:
        for r in batch.orderBy("number").collect():  # one row
            handle(between(journal, r.after, r.until), r.asDict())

    return windows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).start()


def drained(log: AdmissionLog, journal: DataFrame, handle: Handle, checkpoint: str, after: str | None = None) -> None:
    """Run the stream until all that is logged has been handled, then stop it."""
    query = started(log, journal, handle, checkpoint, after)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
