"""Registered queries that run streams over the journal, with the SQL of their rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tagflow.operators import journal as J
from tagflow.plans import catalogue as C
from tagflow.sources.scratch import shared_folder
from tagflow.sources.sinks import StateStore
from tagflow.streaming import admission as A
from tagflow.streaming import ledger as L
from tagflow.streaming import processed as P

SINCE = f"TIMESTAMP '{C.MARK}' - INTERVAL 1 DAY"


@C.query(f""", near AS (SELECT * FROM u WHERE bucket IN ('lake-0', 'lake-1') AND record_timestamp > {SINCE}),
done AS (SELECT lid FROM d WHERE bucket IN ('lake-0', 'lake-1') AND CAST(sequence_number AS BIGINT) % 4 = 0 AND record_timestamp <= TIMESTAMP '{C.MARK}'),
best AS (SELECT *, row_number() OVER (PARTITION BY lid ORDER BY sequence_number DESC, record_timestamp) AS p FROM near)
SELECT {C.COLS} FROM best WHERE p = 1 AND (record_timestamp > TIMESTAMP '{C.MARK}' OR lid NOT IN (SELECT lid FROM done))""")
def stream_unprocessed(spark, sf):
    """Acknowledged identities are state of the stream; then come all operations, late ones too, then acknowledgements of what was let through, then everything again."""
    marked = F.col("bucket").isin("lake-0", "lake-1")
    whole = C.updates(spark, sf).where(marked)
    known = C.newest(spark, sf).where(marked & (F.col("sequence_number").cast("long") % 4 == 0) & (F.col("record_timestamp") <= C.ntz(C.MARK)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema)
    stream = P.Journaled(spark, f"{shared_folder(spark)}/unprocessed-{uuid.uuid4()}", schema, f"{C.DAY} seconds")
    stream.append(P.acknowledgements(known.select("lid", C.ntz(C.MARK).alias("mark"))))
    stream.advance()
    stream.append(P.operations(whole))
    sent = stream.advance()
    marks = J.high_water_mark(sent).select(F.col("bucket").alias("b"), F.col("high_water_mark").alias("mark"))
    stream.append(P.acknowledgements(sent.join(marks, F.col("bucket") == F.col("b")).select("lid", "mark")))
    stream.advance()
    stream.append(P.operations(whole))
    return stream.advance().select(*C.ROW)


@C.query(f"SELECT {C.COLS} FROM u")
def stream_handed_over(spark, sf):
    """Micro-batches of the journal are handed over, then all again by a stream that lost its checkpoint: each row goes out once."""
    folder = f"{shared_folder(spark)}/handed-{uuid.uuid4()}"
    C.updates(spark, sf).select(*C.ROW).repartitionByRange(3, "record_timestamp").write.parquet(f"{folder}/journal")
    schema = spark.read.parquet(f"{folder}/journal").schema
    store, sink = StateStore(spark, f"{folder}/ledger"), L.JobSink(spark, f"{folder}/jobs")
    run = L.handing_over(L.Ledger(store, "journal"), sink, f"{folder}/batches", lambda rows: {"rows": rows.count()})
    for k in range(2):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/journal")
        stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{folder}/checkpoint-{k}").trigger(availableNow=True).start().awaitTermination()
    paths = [r["path"] for r in sink.submissions()]
    return spark.read.schema(schema).parquet(*paths)


@C.query(f""", q AS (SELECT greatest({C.CAP}, count(*) // 6) AS cap FROM w), t AS (SELECT record_timestamp AS ts, sum(count(*)) OVER (ORDER BY record_timestamp) AS upto FROM w GROUP BY record_timestamp),
c AS (WITH RECURSIVE r AS (SELECT min(upto) AS upto FROM t, q WHERE upto >= cap UNION ALL SELECT * FROM (SELECT min(t.upto) AS upto FROM r, q, t WHERE t.upto >= r.upto + cap HAVING min(t.upto) IS NOT NULL)) SELECT * FROM r)
SELECT {C.COLS}, (SELECT count(*) FROM c WHERE c.upto < t.upto) AS batch FROM w JOIN t ON ts = record_timestamp""")
def stream_admitted(spark, sf):
    """The journal as a stream of capped batches: some are admitted and read, then a new stream goes on from the checkpoint with what was admitted since."""
    folder = f"{shared_folder(spark)}/admitted-{uuid.uuid4()}"
    whole = C.ops(spark, sf).select(*C.ROW)
    cap = max(C.CAP, whole.count() // 6)
    log = A.AdmissionLog(spark, f"{folder}/log")
    half = whole.where(F.col("record_timestamp") <= C.ntz(C.MARK))

    def keep(rows, window):
        rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={window['number']}")

    for settled, last in ((half, False), (whole, True)):
        log.admit(settled, cap, last)
        A.drained(log, whole, keep, f"{folder}/checkpoint")
    return spark.read.schema(whole.schema.add("batch", "long")).parquet(f"{folder}/rows")
