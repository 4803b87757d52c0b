"""The stream of identities against the plain table, row by row."""

from pyspark.sql import functions as F

from tagflow.functions.columns import identity
from tagflow.plans import catalogue


def test_stream_has_each_identity_of_the_journal_once(spark, sf):
    lid = identity(F.col("bucket"), F.col("key"), F.col("version_id"), F.col("object_tags")).alias("lid")
    whole = catalogue.journal(spark, sf).where("record_type = 'UPDATE_METADATA'").select("bucket", "key", "version_id", "sequence_number", lid)
    rows = catalogue.queries()["stream_dedup_within_watermark"](spark, sf)
    w = whole.distinct()
    same = [rows[c].eqNullSafe(w[c]) for c in ("bucket", "key", "version_id", "sequence_number")]
    got = [r.lid for r in rows.join(w, same).select("lid").collect()]
    assert sorted(got) == sorted(r.lid for r in whole.select("lid").distinct().collect())


def test_batches_of_a_stream_are_handed_on_once(spark, sf, tmp_path):
    from tagflow.streaming.journal import in_batches

    seen = []
    spark.range(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    for _ in range(2):
        in_batches(stream, lambda rows, number: seen.append((number, rows.count())), str(tmp_path / "state")).awaitTermination()
    assert sum(n for _, n in seen) == 5
