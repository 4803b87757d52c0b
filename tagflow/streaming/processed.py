"""What was submitted, as keyed state of a stream: identities are let through until they are acknowledged.

A row counts as processed when its manifest was submitted, not when it arrives. So the stream has two kinds of rows: operations,
and acknowledgements that a submission sends back. State holds one time for each acknowledged identity, the mark
up to which its bucket was submitted; later operations of the identity are new ones. It is dropped once the watermark, which
trails the stream by the lookback, has passed that mark: no operation at or before it is let in any more.

A call into the state for each identity costs more than all else, so identities are dealt to shards by a hash: a shard's
marks are one value, read and written once a batch, with one event-time timer, that of its earliest mark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tagflow.functions.columns import identity

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OPERATION, ACKNOWLEDGED = "operation", "acknowledged"
#: What both kinds of rows have; `row` is the operation as JSON text; the time of an acknowledgement is the mark that the submission moved its bucket to.
EVENT = "lid string, kind string, event_time timestamp, sequence_number string, row string"
TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Shards of a new stream: at 40 million identities one has about 40,000 marks, 3 MB. A checkpoint goes on with the number that it began with.
SHARDS = 1024
NEVER = -(2**63)


def _micros(times: pd.Series) -> pd.Series:
    return (times - pd.Timestamp(0)) // pd.Timedelta(microseconds=1)


def _packed(marks: dict[str, int]) -> bytes:
    """Marks (microseconds by identity) as Arrow bytes."""
    table = pa.table({"lid": pa.array(list(marks), pa.string()), "through": pa.array(list(marks.values()), pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> dict[str, int]:
    table = pa.ipc.open_stream(data).read_all()
    return dict(zip(table["lid"].to_pylist(), table["through"].to_pylist(), strict=True))


def _due(marks: dict[str, int]) -> int:
    """The first millisecond after the earliest mark."""
    return min(marks.values()) // 1000 + 1


class Unprocessed(StatefulProcessor):
    """Lets the newest operation of an identity through in every batch that has one, unless it was acknowledged; the key is a shard of identities."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.done = handle.getValueState("marks", "marks binary")

    def _known(self) -> dict[str, int]:
        held = self.done.get()
        return {} if held is None else _unpacked(bytes(held[0]))

    def _keep(self, marks: dict[str, int], due: int | None) -> None:
        """Keep the marks, and one timer for them; `due` is that which is set."""
        self.done.update((_packed(marks),))
        if due != _due(marks):
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(_due(marks))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        newest, told = {}, {}
        for frame in rows:
            at = _micros(frame["event_time"]).tolist()
            # plain dicts: the hash tables of pandas take an identity for ended at its first NUL
            for lid, kind, when, seq, row in zip(frame["lid"], frame["kind"], at, frame["sequence_number"], frame["row"], strict=True):
                if kind == ACKNOWLEDGED:
                    told[lid] = max(told.get(lid, NEVER), int(when))
                # the highest sequence, of those the earliest time, as in the batch operator
                elif lid not in newest or (seq, -when) > newest[lid][:2]:
                    newest[lid] = (seq, -when, row)
        marks = self._known()
        moved = {lid: through for lid, through in told.items() if through > marks.get(lid, NEVER)}
        if moved:
            due = _due(marks) if marks else None
            marks |= moved
            self._keep(marks, due)
        out = [(lid, row) for lid, (_, back, row) in newest.items() if not -back <= marks.get(lid, NEVER)]
        if out:
            yield pd.DataFrame(out, columns=["lid", "row"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        marks = {lid: through for lid, through in self._known().items() if through > passed}
        if marks:
            self._keep(marks, expiredTimerInfo.getExpiryTimeInMs())
        else:
            self.done.clear()
        yield from ()

    def close(self) -> None:
        pass


def operations(ops: DataFrame) -> DataFrame:
    """Journal rows as events."""
    lid = identity(F.col("bucket"), F.col("key"), F.col("version_id"), F.col("object_tags"))
    return ops.select(lid.alias("lid"), F.lit(OPERATION).alias("kind"), F.col("record_timestamp").cast("timestamp").alias("event_time"), "sequence_number", F.to_json(F.struct(*ops.columns), TIMES).alias("row"))


def acknowledgements(references: DataFrame) -> DataFrame:
    """Submitted references (lid, and the mark of their bucket after the submission) as events."""
    none = F.lit(None).cast("string")
    return references.select("lid", F.lit(ACKNOWLEDGED).alias("kind"), F.col("mark").cast("timestamp").alias("event_time"), none.alias("sequence_number"), none.alias("row"))


def unprocessed(events: DataFrame, schema: str, lookback: str, shards: int = SHARDS) -> DataFrame:
    """The operations of a stream of events (columns EVENT) that no acknowledgement covers; `schema` is that of the journal rows.

    `lookback` is the delay of the watermark; operations at or before the watermark are dropped by the engine. `shards` must stay what it
    was when the checkpoint was begun.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    keyed = events.withWatermark("event_time", lookback).withColumn("shard", F.pmod(F.xxhash64("lid"), F.lit(shards)).cast("int")).groupBy("shard")
    out = keyed.transformWithStateInPandas(Unprocessed(), "lid string, row string", "Append", "EventTime")
    return out.select("lid", F.inline(F.array(F.from_json("row", schema, TIMES))))


class Journaled:
    """A folder of events and the table of what its stream let through; `advance` takes in all that was appended since."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, lookback: str) -> None:
        self.spark, self.folder, self.schema, self.lookback = spark, folder, schema, lookback
        self.out = None

    def append(self, events: DataFrame) -> None:
        events.write.mode("append").parquet(f"{self.folder}/events")

    def advance(self) -> DataFrame:
        """Run the stream over new events, from its checkpoint; returns all rows let through so far."""
        stream = self.spark.readStream.schema(EVENT).parquet(f"{self.folder}/events")
        out = unprocessed(stream, self.schema, self.lookback)
        query = out.writeStream.format("parquet").option("path", f"{self.folder}/rows").option("checkpointLocation", f"{self.folder}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        return self.spark.read.schema(out.schema).parquet(f"{self.folder}/rows")
