"""Exactly-once hand-over of micro-batches.

`foreachBatch` runs a batch again after a failure, and all of them after a lost checkpoint. Here the number of the last batch that was taken
stands in the same versioned document as the state that it led to, so a batch is either in both or in neither; and the
sink knows a submission by its token, so what was handed over before the state was written is not handed over twice.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagflow.sources.sinks import Files, StateStore


class JobSink:
    """Submissions as one small file each, named by their token: the first one stands."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.files = Files(spark, folder)

    def submit(self, token: str, record: dict) -> bool:
        """True for a new submission, False for one that was there."""
        try:
            self.files.write(f"{token}.json", json.dumps(record, sort_keys=True))
        except FileExistsError:
            return False
        return True

    def submissions(self) -> list[dict]:
        return [json.loads(self.files.read(n)) for n in sorted(self.files.names()) if n.endswith(".json") and not n.startswith(".")]


class Ledger:
    """Batches of one named stream: `{"batch": last number, "state": what the batches made of it}`."""

    def __init__(self, store: StateStore, name: str) -> None:
        self.store, self.name = store, name

    def last(self) -> int:
        document, _ = self.store.read(self.name)
        return document["batch"] if document else -1

    def state(self) -> dict:
        document, _ = self.store.read(self.name)
        return document["state"] if document else {}

    def token(self, number: int) -> str:
        return hashlib.md5(f"{self.name}/{number}".encode()).hexdigest()

    def take(self, number: int, work: Callable[[dict, str], dict]) -> bool:
        """Run `work(state, token)` for a batch that was not taken yet and write what it returns with the batch's number.

        Two writers cannot both take it: the second finds another version and gets StateConflict.
        """
        document, version = self.store.read(self.name)
        document = document or {"batch": -1, "state": {}}
        if number <= document["batch"]:
            return False
        state = work(dict(document["state"]), self.token(number))
        self.store.write(self.name, {"batch": number, "state": state}, version)
        return True


def handing_over(ledger: Ledger, sink: JobSink, folder: str, record: Callable[[DataFrame], dict]) -> Callable[[DataFrame, int], None]:
    """A function for `foreachBatch`: the batch's rows become a table, its record a submission, and both are noted.

    `record(rows)` is a small summary of the batch. The table is written over whatever a failed try left.
    """

    def run(rows: DataFrame, number: int) -> None:
        def work(state: dict, token: str) -> dict:
            path = f"{folder}/batch-{token}"
            rows.write.mode("overwrite").parquet(path)
            table = rows.sparkSession.read.schema(rows.schema).parquet(path)
            sink.submit(token, record(table) | {"token": token, "path": path})
            return {"submitted": state.get("submitted", 0) + 1}

        ledger.take(number, work)

    return run
