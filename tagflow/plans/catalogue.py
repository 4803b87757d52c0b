"""The registered queries over the synthesized journal, each with its DuckDB counterpart.

A query is a function of (spark, sf_dir); its SQL stands beside it in SQL[name]. The SQL builds the
same journal by the same formulas and uses the plain text of an identity where the engine
uses a digest.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.functions import columns as C
from tagflow.operators import journal as J
from tagflow.operators import manifest as M
from tagflow.operators import preflight as B
from tagflow.operators import reports as P
from tagflow.operators import rules as R
from tagflow.operators import state as S
from tagflow.operators import tracking as T
from tagflow.operators.retention import doomed
from tagflow.plans.tracking import ITEMS
from tagflow.sources import codecs as D
from tagflow.sources import processed as W
from tagflow.sources.items import ItemTable
from tagflow.sources.journal import from_events
from tagflow.sources.reports import parsed as parsed_report
from tagflow.sources.scratch import shared_folder, written
from tagflow.sources.sinks import StateStore

SINCE, UNTIL, MARK = datetime(2024, 1, 5), datetime(2024, 1, 25), datetime(2024, 1, 15)
DAY = 86400
CAP = 500
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def ntz(t: datetime):
    return F.lit(t.isoformat(" ")).cast("timestamp_ntz")


# ---------------------------------------------------------------- the chain of inputs

def journal(spark: SparkSession, sf: str) -> DataFrame:
    return from_events(spark.read.parquet(f"{sf}/events.parquet"))


def ops(spark: SparkSession, sf: str) -> DataFrame:
    return J.window(journal(spark, sf), ntz(SINCE), ntz(UNTIL))


def updates(spark: SparkSession, sf: str) -> DataFrame:
    return J.window(journal(spark, sf))


def newest(spark: SparkSession, sf: str) -> DataFrame:
    good = J.validity(updates(spark, sf)).where("error_reason IS NULL").drop("error_reason")
    return J.latest(good)


def live(spark: SparkSession, sf: str) -> DataFrame:
    return J.without_archived(newest(spark, sf))


def matches(spark: SparkSession, sf: str) -> DataFrame:
    return R.match(live(spark, sf), R.inline_rules(spark))


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    return M.union(matches(spark, sf))


def deletes(spark: SparkSession, sf: str) -> DataFrame:
    return J.permanent_deletes(journal(spark, sf))


def state(spark: SparkSession, lease: bool = False) -> DataFrame:
    rows = [("lake-0", MARK, datetime(2024, 1, 16) if lease else None), ("lake-1", MARK, None)]
    return spark.createDataFrame(rows, "bucket string, watermark timestamp_ntz, lease_mark timestamp_ntz")


def processed(spark: SparkSession, sf: str) -> DataFrame:
    return newest(spark, sf).where(F.col("sequence_number").cast("long") % 4 == 0).select("lid")


def eligible(spark: SparkSession, sf: str) -> DataFrame:
    return J.eligible(newest(spark, sf), state(spark), processed(spark, sf), DAY)


CHAIN = f"""WITH base AS (
 SELECT event_id AS e, ts, event_type, 'lake-' || CAST(user_id % 3 AS VARCHAR) AS bucket, 'u/' || CAST(user_id AS VARCHAR) || '/' || event_type AS key,
  CASE WHEN event_id % 5 <> 0 THEN 'v' || CAST(event_id % 3 AS VARCHAR) END AS version_id, json_extract_string(props, '$.k') AS k FROM events),
j AS (
 SELECT bucket, key, version_id, CASE WHEN e % 10 = 9 THEN 'DELETE' WHEN e % 10 = 8 THEN 'PUT' ELSE 'UPDATE_METADATA' END AS record_type, event_type AS type, k,
  lpad(CAST(e AS VARCHAR), 12, '0') AS sequence_number, ts AS record_timestamp,
  CASE WHEN event_type = 'error' AND e % 2 = 0 THEN 'GLACIER' WHEN e % 11 = 0 THEN NULL ELSE 'STANDARD' END AS storage_class, e % 20 = 9 AS is_delete_marker FROM base
 UNION ALL
 SELECT bucket, key, version_id, 'UPDATE_METADATA', event_type, k, lpad(CAST(e + 500000 AS VARCHAR), 12, '0'), ts, CASE WHEN e % 14 = 0 THEN 'DEEP_ARCHIVE' ELSE 'STANDARD' END, e % 20 = 9
 FROM base WHERE e % 7 = 0 AND e % 10 < 8),
u AS (SELECT *, bucket || '|' || key || '|' || coalesce(version_id, '<null>') || '|' || type || '|' || coalesce(k, '') AS lid FROM j
 WHERE record_type = 'UPDATE_METADATA'),
w AS (SELECT * FROM u WHERE record_timestamp > TIMESTAMP '{SINCE}' AND record_timestamp <= TIMESTAMP '{UNTIL}'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lid ORDER BY sequence_number DESC, record_timestamp) AS r, min(record_timestamp) OVER (PARTITION BY lid) AS first_seen, count(*) OVER (PARTITION BY lid) AS deliveries FROM u),
d AS (SELECT * FROM ranked WHERE r = 1),
a AS (SELECT * FROM d WHERE NOT coalesce(upper(trim(storage_class)) IN ('GLACIER', 'DEEP_ARCHIVE'), false)),
rules(rb, config_id, rule_id, rt, rk, dest, prefix) AS (VALUES ('lake-0', 'c0', 'r1', 'click', NULL, 'copy-a', 'u/1'), ('lake-1', 'c1', 'r2', 'view', NULL, 'copy-b', NULL), ('lake-2', 'c2', 'r3', 'purchase', '7', 'copy-c', NULL), ('lake-0', 'c0', 'r4', 'click', NULL, 'copy-d', NULL)),
m AS (SELECT a.*, config_id, rule_id, dest FROM a JOIN rules ON bucket = rb AND type = rt AND (rk IS NULL OR k = rk) AND (prefix IS NULL OR starts_with(key, prefix))),
firsts AS (SELECT bucket, key, version_id, record_timestamp, row_number() OVER (PARTITION BY bucket, key ORDER BY first_seen, lid) AS r FROM m),
labels_of AS (SELECT bucket, key, string_agg(DISTINCT rule_id, ',' ORDER BY rule_id) AS rules, string_agg(DISTINCT dest, ',' ORDER BY dest) AS destinations FROM m GROUP BY bucket, key),
mf AS (SELECT f.bucket, f.key, f.version_id, f.record_timestamp AS tagged_at, l.rules, l.destinations FROM firsts f JOIN labels_of l ON f.bucket = l.bucket AND f.key = l.key WHERE r = 1),
del AS (SELECT DISTINCT bucket, key, version_id FROM j WHERE (record_type = 'DELETE' AND NOT coalesce(is_delete_marker, false)) OR (record_type IN ('PUT', 'COPY', 'RESTORE') AND version_id IS NULL)),
kept AS (SELECT * FROM mf WHERE NOT EXISTS (SELECT 1 FROM del WHERE del.bucket = mf.bucket AND del.key = mf.key AND del.version_id IS NOT DISTINCT FROM mf.version_id)),
state(sb, mark) AS (VALUES ('lake-0', TIMESTAMP '{MARK}'), ('lake-1', TIMESTAMP '{MARK}')),
el AS (SELECT d.*, mark FROM d LEFT JOIN state ON bucket = sb WHERE mark IS NULL OR record_timestamp > mark OR (record_timestamp > mark - INTERVAL 1 DAY AND CAST(sequence_number AS BIGINT) % 4 <> 0))
"""

ROW = ["bucket", "key", "version_id", "sequence_number", "record_timestamp", "storage_class"]
COLS = ", ".join(ROW)


def query(sql: str | None):
    """Register a query with its SQL (after the common chain)."""

    def wrap(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql if sql.startswith("WITH ") else CHAIN + sql
        return f

    return wrap


# ---------------------------------------------------------------- journal

@query(f"SELECT record_type, {COLS}, is_delete_marker FROM j")
def journal_scan(spark, sf):
    return journal(spark, sf).select("record_type", *ROW, "is_delete_marker")


@query("SELECT bucket, count(*) AS n, min(record_timestamp) AS first_at, max(record_timestamp) AS last_at FROM w GROUP BY bucket")
def journal_window_bounds(spark, sf):
    return ops(spark, sf).groupBy("bucket").agg(F.count("*").alias("n"), F.min("record_timestamp").alias("first_at"), F.max("record_timestamp").alias("last_at"))


@query(f"SELECT {COLS}, type, k FROM w")
def journal_projection(spark, sf):
    return ops(spark, sf).select(*ROW, F.col("object_tags")["type"].alias("type"), F.col("object_tags")["k"].alias("k"))


@query("SELECT error_reason, count(*) AS n FROM (SELECT CASE WHEN kk = '' THEN 'empty key' WHEN untagged THEN 'no tags' END AS error_reason FROM (SELECT CASE WHEN CAST(sequence_number AS BIGINT) % 13 = 0 THEN '' ELSE key END AS kk, CAST(sequence_number AS BIGINT) % 17 = 0 AS untagged FROM u)) GROUP BY error_reason")
def journal_validity_split(spark, sf):
    seq = F.col("sequence_number").cast("long")
    broken = updates(spark, sf).withColumn("key", F.when(seq % 13 == 0, "").otherwise(F.col("key"))).withColumn("object_tags", F.when(seq % 17 != 0, F.col("object_tags")))
    return J.validity(broken).groupBy("error_reason").agg(F.count("*").alias("n"))


@query(f"SELECT {COLS}, deliveries FROM d")
def journal_dedup_latest(spark, sf):
    return newest(spark, sf).select(*ROW, "deliveries")


@query("SELECT bucket, key, version_id, sequence_number, first_seen FROM d")
def journal_identity_first_seen(spark, sf):
    return newest(spark, sf).select("bucket", "key", "version_id", "sequence_number", F.col("first_seen.record_timestamp").alias("first_seen"))


@query(f"SELECT record_timestamp AS boundary FROM w ORDER BY record_timestamp LIMIT 1 OFFSET {CAP - 1}")
def row_cap_boundary(spark, sf):
    return J.row_cap_boundary(ops(spark, sf), CAP).select(F.col("record_timestamp").alias("boundary"))


@query(f"SELECT {COLS} FROM (SELECT *, rank() OVER (ORDER BY record_timestamp) AS rk FROM w) WHERE rk <= {CAP}")
def row_cap_with_ties(spark, sf):
    return J.with_ties(ops(spark, sf), CAP).select(*ROW)


@query(f""", t AS (SELECT record_timestamp AS ts, sum(count(*)) OVER (ORDER BY record_timestamp) AS upto FROM w GROUP BY record_timestamp),
c AS (WITH RECURSIVE r AS (SELECT min(upto) AS upto FROM t WHERE upto >= {CAP} UNION ALL SELECT * FROM (SELECT min(t.upto) AS upto FROM r JOIN t ON t.upto >= r.upto + {CAP} HAVING min(t.upto) IS NOT NULL)) SELECT * FROM r)
SELECT {COLS}, (SELECT count(*) FROM c WHERE c.upto < t.upto) AS batch FROM w JOIN t ON ts = record_timestamp""")
def row_cap_chain(spark, sf):
    """Every row with the number of the capped run that reads it."""
    return J.capped_batches(ops(spark, sf), CAP).select(*ROW, "batch")


@query(f"SELECT {COLS} FROM d LEFT JOIN state ON bucket = sb WHERE mark IS NULL OR record_timestamp > mark")
def eligibility_after_watermark(spark, sf):
    none = newest(spark, sf).where(F.lit(False)).select("lid")
    return J.eligible(newest(spark, sf), state(spark), none, 0).select(*ROW)


@query(f"SELECT {COLS} FROM el WHERE record_timestamp <= mark")
def late_arrivals_in_lookback(spark, sf):
    return eligible(spark, sf).where(F.col("bucket").isin("lake-0", "lake-1") & (F.col("record_timestamp") <= ntz(MARK))).select(*ROW)


@query(f"SELECT {COLS} FROM el")
def processed_suppression(spark, sf):
    return eligible(spark, sf).select(*ROW)


@query(f"SELECT {COLS} FROM el WHERE NOT (bucket = 'lake-0' AND record_timestamp <= TIMESTAMP '2024-01-16')")
def lease_guard(spark, sf):
    return J.eligible(newest(spark, sf), state(spark, lease=True), processed(spark, sf), DAY).select(*ROW)


@query("SELECT bucket, max(record_timestamp) AS high_water_mark FROM el GROUP BY bucket")
def candidate_high_water_mark(spark, sf):
    return J.high_water_mark(eligible(spark, sf))


@query("SELECT coalesce(upper(trim(storage_class)) IN ('GLACIER', 'DEEP_ARCHIVE'), false) AS archived, count(*) AS n FROM d GROUP BY 1")
def archived_split(spark, sf):
    return newest(spark, sf).groupBy(C.is_archived(F.col("storage_class")).alias("archived")).agg(F.count("*").alias("n"))


@query("SELECT coalesce(upper(trim(storage_class)), 'UNKNOWN') AS storage_class, count(*) AS n FROM d GROUP BY 1")
def archived_counts(spark, sf):
    return newest(spark, sf).groupBy(F.coalesce(F.upper(F.trim("storage_class")), F.lit("UNKNOWN")).alias("storage_class")).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- rules

KINDS = ["click", "view", "purchase", "signup", "error"]
#: Rules of the documents that `documents` makes, by formula.
RULES = f"""cfg AS (SELECT c_custkey AS c, 'lake-' || CAST(c_custkey % 3 AS VARCHAR) AS rb, 'cfg-' || CAST(c_custkey AS VARCHAR) AS config_id, 'r' || CAST(c_custkey AS VARCHAR) AS rule_id,
 CASE WHEN c_custkey % 4 <> 1 THEN list_extract({KINDS}, c_custkey % 5 + 1) END AS rt, CASE WHEN c_custkey % 4 IN (1, 2) THEN CAST(c_custkey % 100 AS VARCHAR) END AS rk,
 CASE c_custkey % 4 WHEN 1 THEN NULL WHEN 2 THEN 'u/' || CAST(c_custkey AS VARCHAR) ELSE 'u/' || CAST(c_custkey AS VARCHAR) || '/' END AS prefix FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0)"""


def documents(spark, sf):
    """Configuration documents by fixed formulas, one for each customer: filters of all shapes, repeated tags, disabled rules and rules without tags."""
    c = F.col("c_custkey")
    user, kind = c.cast("string"), F.element_at(F.array(*map(F.lit, KINDS)), (c % 5 + 1).cast("int"))
    pair = lambda k, v: F.concat(F.lit(f'{{"Key": "{k}", "Value": "'), v, F.lit('"}'))
    typed, number = pair("type", kind), pair("k", (c % 100).cast("string"))
    shape = F.when(c % 4 == 0, F.concat(F.lit('{"And": {"Prefix": "u/'), user, F.lit('/", "Tags": ['), typed, F.lit("]}}")))
    shape = shape.when(c % 4 == 1, F.concat(F.lit('{"Prefix": "", "Tag": '), number, F.lit("}")))
    shape = shape.when(c % 4 == 2, F.concat(F.lit('{"And": {"Prefix": "u/'), user, F.lit('", "Tags": [{"Key": "k", "Value": "none"}, '), typed, F.lit(", "), number, F.lit("]}}")))
    shape = shape.otherwise(F.concat(F.lit('{"And": {"Prefix": "u/'), user, F.lit('/", "Tag": '), typed, F.lit("}}")))
    rule = F.concat(F.lit('{"ID": "r'), user, F.lit('", "Status": "'), F.when(c % 13 == 0, "Disabled").otherwise("Enabled"), F.lit('", "Destination": {"Bucket": "arn:aws:s3:::copy"}, "Filter": '), shape, F.lit("}, "))
    text = F.concat(F.lit('{"Rules": ['), F.when(c % 11 == 0, "").otherwise(rule), F.lit('{"ID": "bare", "Status": "Enabled", "Filter": {"Prefix": "u/"}}]}'))
    # a file of few row groups would be parsed by few tasks
    read = spark.read.parquet(f"{sf}/customer.parquet").select(c).repartition(c).select(c, F.concat(F.lit("lake-"), (c % 3).cast("string")).alias("bucket"), F.concat(F.lit("cfg-"), user).alias("config_id"), F.from_json(text, R.DOCUMENT).alias("d"))
    return read.select("c_custkey", "bucket", "config_id", "d.Rules")


def derived_rules(spark, sf):
    return R.derive(documents(spark, sf), enabled_only=True)


@query(f"WITH {RULES} SELECT rb AS bucket, config_id, rule_id, concat_ws(',', rt, rk) AS tag_values, prefix AS key_prefix FROM cfg")
def rule_derivation(spark, sf):
    tags = F.concat_ws(",", F.col("tag_filter")["type"], F.col("tag_filter")["k"])
    return derived_rules(spark, sf).select("bucket", "config_id", "rule_id", tags.alias("tag_values"), "key_prefix")


@query(f", {RULES} SELECT bucket, key, version_id, sequence_number, config_id, rule_id FROM a JOIN cfg ON bucket = rb AND (rt IS NULL OR type = rt) AND (rk IS NULL OR k = rk) AND (prefix IS NULL OR starts_with(key, prefix))")
def rule_match_index(spark, sf):
    """The live journal against the rules of every customer's document, each rule met by its rarest term."""
    rows = live(spark, sf).select("lid", "bucket", "key", "version_id", "sequence_number", "object_tags")
    return R.match_by_index(rows, derived_rules(spark, sf)).select("bucket", "key", "version_id", "sequence_number", "config_id", "rule_id")


@query("SELECT bucket, key, count(*) AS n FROM u WHERE CAST(sequence_number AS BIGINT) % 17 = 0 GROUP BY bucket, key")
def match_errors(spark, sf):
    """Operations whose tags could not be read (every 17th here) as error rows, counted by object."""
    unread = F.when(F.col("sequence_number").cast("long") % 17 != 0, F.col("object_tags"))
    return R.errors(updates(spark, sf).withColumn("object_tags", unread)).groupBy("bucket", "key").agg(F.count("reason").alias("n"))


@query("SELECT bucket, key, version_id, sequence_number, config_id, rule_id FROM m")
def rule_match(spark, sf):
    return matches(spark, sf).select("bucket", "key", "version_id", "sequence_number", "config_id", "rule_id")


@query("SELECT bucket, key, version_id, sequence_number, config_id, rule_id FROM m")
def rule_match_division(spark, sf):
    return R.match_by_tags(live(spark, sf), R.inline_rules(spark)).select("bucket", "key", "version_id", "sequence_number", "config_id", "rule_id")


@query("SELECT bucket, key, config_id, string_agg(DISTINCT rule_id, ',' ORDER BY rule_id) AS rules, string_agg(DISTINCT 'arn:aws:s3:::' || dest, ',' ORDER BY 'arn:aws:s3:::' || dest) AS destinations FROM m GROUP BY lid, bucket, key, config_id")
def rule_match_grouped(spark, sf):
    return R.grouped(matches(spark, sf)).select("bucket", "key", "config_id", F.concat_ws(",", "rules").alias("rules"), F.concat_ws(",", "destinations").alias("destinations"))


@query("SELECT count(DISTINCT key) AS n FROM u WHERE bucket = 'lake-0' AND ((type = 'click' AND starts_with(key, 'u/1')) OR type = 'click')")
def rule_predicate_count(spark, sf):
    condition = R.predicate_of(R.inline_rules(spark).where("bucket = 'lake-0'"))
    return updates(spark, sf).where((F.col("bucket") == "lake-0") & condition).agg(F.countDistinct("key").alias("n"))


@query("SELECT bucket, CAST(record_timestamp AS DATE) AS day, count(DISTINCT key) > 70 AS over_limit FROM u GROUP BY ALL")
def preflight_over_limit(spark, sf):
    """Whether a bucket's day holds more than 70 keys: sketches by hour decide, keys are counted where they cannot."""
    return B.over_limit(updates(spark, sf), 70).select("bucket", F.to_date("period").alias("day"), "over_limit")


@query("SELECT bucket, count(DISTINCT key) AS matches FROM u JOIN rules ON bucket = rb AND type = rt AND (rk IS NULL OR k = rk) AND (prefix IS NULL OR starts_with(key, prefix)) GROUP BY bucket")
def preflight_matches(spark, sf):
    return B.matched_keys(updates(spark, sf), R.inline_rules(spark))


# ---------------------------------------------------------------- manifest

@query("SELECT bucket, key, rules FROM mf")
def manifest_union(spark, sf):
    return manifest(spark, sf).select("bucket", "key", F.concat_ws(",", "rules").alias("rules"))


@query("SELECT bucket, key, version_id, tagged_at FROM mf")
def manifest_first_version(spark, sf):
    return manifest(spark, sf).select("bucket", "key", "version_id", "tagged_at")


@query("SELECT bucket, key, destinations FROM mf")
def manifest_routing(spark, sf):
    return manifest(spark, sf).select("bucket", "key", F.concat_ws(",", "destinations").alias("destinations"))


@query("SELECT bucket, bucket || ',' || key || ',' || coalesce(version_id, 'null') AS row FROM mf")
def manifest_rows(spark, sf):
    return M.rendered(manifest(spark, sf))


PART = "substr(md5(key), 1, 3)"


@query(f"""SELECT bucket, sum(n)::BIGINT AS object_count, md5(string_agg(part_sum, '' ORDER BY part)) AS checksum FROM (
 SELECT bucket, {PART} AS part, count(*) AS n, md5(string_agg(bucket || ',' || key || ',' || coalesce(version_id, 'null'), chr(10) ORDER BY key)) AS part_sum FROM mf GROUP BY bucket, {PART}) GROUP BY bucket""")
def manifest_checksum(spark, sf):
    return M.checksums(manifest(spark, sf))


@query("SELECT bucket, key, version_id FROM del")
def permanent_deletes(spark, sf):
    return deletes(spark, sf)


@query("SELECT bucket, key, version_id, tagged_at, rules, destinations FROM kept")
def manifest_minus_deletes(spark, sf):
    out = M.without_deleted(manifest(spark, sf), deletes(spark, sf))
    return out.withColumns({"rules": F.concat_ws(",", "rules"), "destinations": F.concat_ws(",", "destinations")})


# ---------------------------------------------------------------- state

@query(f"SELECT {COLS} FROM a WHERE EXISTS (SELECT 1 FROM kept WHERE kept.bucket = a.bucket AND kept.key = a.key AND kept.version_id IS NOT DISTINCT FROM a.version_id)")
def submitted_refs(spark, sf):
    kept = M.without_deleted(manifest(spark, sf), deletes(spark, sf))
    return M.references(live(spark, sf), kept).select(*ROW)


@query("SELECT bucket, key, version_id, max(record_timestamp) AS watermark, count(*) AS n FROM u LEFT JOIN state ON bucket = sb WHERE mark IS NULL OR record_timestamp > mark - INTERVAL 1 DAY GROUP BY bucket, key, version_id")
def window_prune(spark, sf):
    named = updates(spark, sf).withColumn("lid", F.concat_ws("|", "bucket", "key", F.coalesce("version_id", F.lit("<null>")), "sequence_number"))
    kept = S.prune(named.select("bucket", "lid", "record_timestamp"), state(spark).drop("lease_mark"), DAY)
    parts = F.split("lid", r"\|")
    return kept.groupBy("bucket", parts[1].alias("key"), F.when(parts[2] != "<null>", parts[2]).alias("version_id")).agg(F.max("watermark").alias("watermark"), F.count("*").alias("n"))


@query(f"SELECT bucket, lid, record_timestamp AS watermark FROM d WHERE NOT (bucket = 'lake-0' AND CAST(sequence_number AS BIGINT) % 3 = 0 AND record_timestamp > TIMESTAMP '{MARK}')")
def window_generations(spark, sf):
    """The processed window after three runs; before the second the mark of one bucket was set back."""
    tag = lambda k: F.coalesce(F.col("object_tags")[k], F.lit(""))
    lid = F.concat_ws("|", "bucket", "key", F.coalesce("version_id", F.lit("<null>")), tag("type"), tag("k"))
    rows = newest(spark, sf).select("bucket", lid.alias("lid"), F.col("record_timestamp").alias("watermark"), (F.col("sequence_number").cast("long") % 3).alias("run"))
    rows = written(rows)  # each run reads its rows twice
    root, window = f"{shared_folder(spark)}/{uuid.uuid4()}", None
    for run in range(3):
        part = rows.where(F.col("run") == run)
        window = W.append(spark, window, root, part, part.count(), {"lake-0": MARK} if run == 1 else {}, None)
    return W.read(spark, window)


@query("SELECT sb AS bucket, CASE WHEN EXISTS (SELECT 1 FROM kept WHERE kept.bucket = sb) THEN greatest(mark, h) ELSE mark END AS watermark FROM state LEFT JOIN (SELECT bucket, max(record_timestamp) AS h FROM el GROUP BY bucket) ON bucket = sb")
def checkpoint_advance(spark, sf):
    kept = M.without_deleted(manifest(spark, sf), deletes(spark, sf))
    return S.advance(state(spark).drop("lease_mark"), J.high_water_mark(eligible(spark, sf)), kept.select("bucket"))


OUTCOMES = """WITH o AS (SELECT 'lake-' || CAST(o_custkey % 3 AS VARCHAR) AS bucket, o_orderkey AS job_id, CASE o_orderstatus WHEN 'F' THEN 'Failed' WHEN 'O' THEN 'Complete' ELSE 'Active' END AS status,
 o_orderkey % 4 AS ok, o_orderkey % 3 AS bad, o_orderkey % 5 AS streak, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000000Z') END AS low FROM orders),
f AS (SELECT *, status = 'Failed' OR (status = 'Complete' AND ok = 0 AND bad > 0) AS failed FROM o) """


def outcomes(spark, sf):
    o, k = spark.read.parquet(f"{sf}/orders.parquet"), F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("lake-"), (F.col("o_custkey") % 3).cast("string")).alias("bucket"),
        k.alias("job_id"),
        F.when(F.col("o_orderstatus") == "F", "Failed").when(F.col("o_orderstatus") == "O", "Complete").otherwise("Active").alias("status"),
        (k % 4).alias("tasks_succeeded"),
        (k % 3).alias("tasks_failed"),
        (k % 5).alias("consecutive_failures"),
        F.when(k % 6 == 0, "").otherwise(C.watermark(F.col("o_orderdate"))).alias("watermark_low"),
    )


@query(OUTCOMES + "SELECT bucket, coalesce(max(CASE WHEN failed THEN streak + 1 END), 0) AS consecutive_failures, min(CASE WHEN failed AND low <> '' THEN low END) AS rollback_to, count(CASE WHEN failed AND low = '' THEN 1 END) AS skipped_empty, coalesce(max(CASE WHEN failed THEN streak + 1 END), 0) >= 3 AS disable FROM f GROUP BY bucket")
def recovery_plan(spark, sf):
    return S.recovery_plan(outcomes(spark, sf), 3)


@query(OUTCOMES + "SELECT bucket, job_id, status FROM f WHERE failed")
def effective_failures(spark, sf):
    o = outcomes(spark, sf)
    return o.where(S.effective_failure(F.col("status"), F.col("tasks_succeeded"), F.col("tasks_failed"))).select("bucket", "job_id", "status")


REPORT = """, rep AS (SELECT bucket, key, version_id, sequence_number, CASE WHEN CAST(sequence_number AS BIGINT) % 3 = 0 THEN 'failed' ELSE 'succeeded' END AS task_status,
 CASE WHEN CAST(sequence_number AS BIGINT) % 3 = 0 THEN CASE WHEN CAST(sequence_number AS BIGINT) % 2 = 0 THEN '403' ELSE '404' END ELSE '200' END AS http_status,
 CASE WHEN CAST(sequence_number AS BIGINT) % 3 = 0 THEN CASE WHEN CAST(sequence_number AS BIGINT) % 2 = 0 THEN 'AccessDenied' ELSE 'NoSuchKey' END END AS error_code FROM a) """


def report(spark, sf):
    """Report rows as files have them: encoded keys, and the last two columns in either order."""
    seq = F.col("sequence_number").cast("long")
    status = F.when(seq % 3 != 0, "200").when(seq % 2 == 0, "403").otherwise("404")
    code = F.when(seq % 3 != 0, "").when(seq % 2 == 0, "AccessDenied").otherwise("NoSuchKey")
    flip = seq % 5 == 0
    return live(spark, sf).select(
        "bucket", C.encode_key(F.col("key")).alias("key"), F.coalesce("version_id", F.lit("null")).alias("version_id"), "sequence_number",
        F.when(seq % 3 == 0, "failed").otherwise("succeeded").alias("task_status"), F.when(flip, code).otherwise(status).alias("c4"), F.when(flip, status).otherwise(code).alias("c5"),
    )


def parsed(spark, sf):
    return parsed_report(report(spark, sf).withColumn("result_message", F.lit("")))


@query(REPORT + "SELECT * FROM rep")
def report_parse(spark, sf):
    return parsed(spark, sf).drop("result_message")


@query(REPORT + "SELECT error_code, count(*) AS n, min(sequence_number) AS first_sequence FROM rep WHERE error_code IS NOT NULL GROUP BY error_code")
def report_error_codes(spark, sf):
    return parsed(spark, sf).where("error_code IS NOT NULL").groupBy("error_code").agg(F.count("*").alias("n"), F.min("sequence_number").alias("first_sequence"))


TRACK = """, items AS (SELECT mf.*, CASE WHEN length(key) % 3 = 0 THEN 'RESOLVED' ELSE 'PENDING' END AS state, length(key) % 2 = 0 AS confirmed,
 CASE length(key) % 4 WHEN 0 THEN 'COMPLETED' WHEN 1 THEN 'FAILED' WHEN 2 THEN 'PENDING' END AS header, CASE length(key) % 5 WHEN 0 THEN 'OBJECT_GONE' WHEN 1 THEN 'HEADER_ABSENT' ELSE 'HEADER_VALUE' END AS kind FROM mf),
rec AS (SELECT *, CASE WHEN expired THEN 'EXPIRED' WHEN kind = 'OBJECT_GONE' THEN 'GONE' WHEN kind = 'HEADER_ABSENT' THEN 'UNKNOWN' WHEN header = 'COMPLETED' THEN 'COMPLETE' ELSE header END AS outcome
 FROM (SELECT *, tagged_at < TIMESTAMP '2024-01-18' AS expired FROM items)) """


def tracked(spark, sf):
    n = F.length("key")
    return manifest(spark, sf).withColumns({
        "state": F.when(n % 3 == 0, "RESOLVED").otherwise("PENDING"),
        "configs": F.create_map(F.lit("c"), n % 2 == 0),
        "manifest_at": F.col("tagged_at"),
        "header": F.when(n % 4 == 0, "COMPLETED").when(n % 4 == 1, "FAILED").when(n % 4 == 2, "PENDING"),
        "kind": F.when(n % 5 == 0, "OBJECT_GONE").when(n % 5 == 1, "HEADER_ABSENT").otherwise("HEADER_VALUE"),
        "expired": S.expired(F.col("tagged_at"), ntz(datetime(2024, 1, 20)), 2 * DAY),
    })


def reconciled(spark, sf):
    return tracked(spark, sf).withColumn("outcome", S.reconcile(F.col("kind"), F.col("header"), F.col("expired")))


@query(", n AS (SELECT bucket, key, version_id, rules, starts_with(key, 'u/1') AS old, NOT starts_with(key, 'u/10') AS fresh FROM mf) SELECT bucket, key, version_id, CASE WHEN old AND fresh THEN 'a,b' WHEN old THEN 'a' ELSE 'b' END AS configs FROM n WHERE old OR fresh")
def tracked_upsert(spark, sf):
    m = manifest(spark, sf)
    old = m.where(F.col("key").startswith("u/1")).select("bucket", "key", "version_id", F.create_map(F.lit("a"), F.lit(True)).alias("configs"), F.lit("PENDING").alias("state"))
    new = m.where(~F.col("key").startswith("u/10")).select("bucket", "key", "version_id", F.create_map(F.lit("b"), F.lit(True)).alias("configs"))
    return S.upsert(old, new).select("bucket", "key", "version_id", F.array_join(F.array_sort(F.map_keys("configs")), ",").alias("configs"))


@query(TRACK + """, n AS (SELECT *, starts_with(key, 'u/1') AS old, NOT starts_with(key, 'u/10') AS fresh FROM mf) SELECT bucket, key, version_id, CASE WHEN old AND fresh THEN 'a:1,b:3' WHEN old THEN 'a:1' ELSE 'b:3' END AS configs, 'PENDING' AS state,
 CASE WHEN old THEN tagged_at ELSE tagged_at + INTERVAL 1 HOUR END AS tagged_at, CASE WHEN old THEN rules ELSE 'late' END AS rules FROM n WHERE old OR fresh""")
def tracked_merge(spark, sf):
    """Reports merged into stored objects: job a, then job b whose report has two rows for each object, then job b once more."""
    job = lambda j, n: F.create_map(F.lit(j), F.struct(F.lit(n).alias("job_id"), F.col("tagged_at").alias("manifest_at"), F.lit(True).alias("confirmed")))
    m = written(manifest(spark, sf).select("bucket", "key", "version_id", "tagged_at", "rules", "destinations"))
    a = m.where(F.col("key").startswith("u/1")).select(F.lit("1").alias("job_id"), F.lit(0).alias("position"), "*", job("a", "1").alias("configs"))
    later = m.where(~F.col("key").startswith("u/10")).withColumns({"tagged_at": F.col("tagged_at") + F.expr("INTERVAL 1 HOUR"), "rules": F.array(F.lit("late"))})
    b = later.select(F.lit("b").alias("job_id"), F.lit(1).alias("position"), "*", job("b", "2").alias("configs")).unionByName(later.select(F.lit("b").alias("job_id"), F.lit(2).alias("position"), "*", job("b", "3").alias("configs")))
    folder = f"{shared_folder(spark)}/items-{uuid.uuid4()}"
    held = ItemTable(spark, StateStore(spark, f"{folder}/state"), folder, ITEMS, 8)
    for rows in (a, b, b):
        held.merge(rows, "position")
    told = F.array_join(F.array_sort(F.transform(F.map_entries("configs"), lambda e: F.concat(e["key"], F.lit(":"), e["value"]["job_id"]))), ",")
    return held.items().select("bucket", "key", "version_id", told.alias("configs"), "state", "tagged_at", F.concat_ws(",", "rules").alias("rules"))


@query(TRACK + "SELECT bucket, key, version_id, tagged_at FROM items WHERE state = 'PENDING' AND confirmed ORDER BY tagged_at, bucket, key LIMIT 20")
def check_candidates(spark, sf):
    return S.check_candidates(tracked(spark, sf), 20).select("bucket", "key", "version_id", "tagged_at")


@query(TRACK + "SELECT bucket, key, version_id, kind, outcome FROM rec")
def reconcile_status(spark, sf):
    return reconciled(spark, sf).select("bucket", "key", "version_id", "kind", "outcome")


@query(TRACK + "SELECT bucket, key, version_id FROM rec WHERE expired AND state = 'PENDING'")
def expired_items(spark, sf):
    return tracked(spark, sf).where(F.col("expired") & (F.col("state") == "PENDING")).select("bucket", "key", "version_id")


def publishable(spark, sf):
    scan = F.when(F.col("bucket") != "lake-2", ntz(datetime(2024, 1, 20)))
    quiet = S.quiescent(scan, F.when(F.col("bucket") == "lake-0", 0).otherwise(1) * F.length("key") % 2, F.col("manifest_at"))
    return tracked(spark, sf).where((F.col("state") == "RESOLVED") & quiet)


PUB = " state = 'RESOLVED' AND bucket <> 'lake-2' AND TIMESTAMP '2024-01-20' > tagged_at AND (bucket = 'lake-0' OR length(key) % 2 = 0)"


@query(TRACK + f"SELECT bucket, key, version_id FROM items WHERE {PUB}")
def publishable_items(spark, sf):
    return publishable(spark, sf).select("bucket", "key", "version_id")


@query(TRACK + "SELECT bucket, rules, destinations, count(*) AS items, min(tagged_at) AS first_tagged, max(tagged_at) AS last_tagged, count(CASE WHEN outcome = 'FAILED' THEN 1 END) AS failed FROM rec GROUP BY bucket, rules, destinations")
def completion_groups(spark, sf):
    g = S.outcome_groups(reconciled(spark, sf))
    return g.select("bucket", F.concat_ws(",", "rules").alias("rules"), F.concat_ws(",", "destinations").alias("destinations"), "items", "first_tagged", "last_tagged", F.coalesce(F.col("outcomes")["FAILED"], F.lit(0)).cast("long").alias("failed"))


@query(TRACK + "SELECT coalesce(outcome, 'NONE') AS outcome, count(*) AS n FROM rec GROUP BY 1")
def outcome_counts(spark, sf):
    return reconciled(spark, sf).groupBy(F.coalesce("outcome", F.lit("NONE")).alias("outcome")).agg(F.count("*").alias("n"))


@query(TRACK + f"SELECT (SELECT count(*) FROM items) - (SELECT count(*) FROM items WHERE {PUB}) AS outstanding")
def outstanding_count(spark, sf):
    ready = publishable(spark, sf).agg(F.count("*").alias("ready"))
    return tracked(spark, sf).agg(F.count("*").alias("total")).join(F.broadcast(ready)).select((F.col("total") - F.col("ready")).alias("outstanding"))  # two single rows


@query("SELECT d.bucket, sum(deliveries)::BIGINT AS raw, count(*) AS ops, sum(deliveries)::BIGINT - count(*) AS duplicates, count(CASE WHEN storage_class IN ('GLACIER', 'DEEP_ARCHIVE') THEN 1 END) AS archived FROM d GROUP BY d.bucket")
def bucket_metrics(spark, sf):
    return newest(spark, sf).groupBy("bucket").agg(F.sum("deliveries").alias("raw"), F.count("*").alias("ops"), (F.sum("deliveries") - F.count("*")).alias("duplicates"), F.count_if(C.is_archived(F.col("storage_class"))).alias("archived"))


@query("SELECT count(DISTINCT bucket) AS buckets, sum(deliveries)::BIGINT AS raw, sum(deliveries)::BIGINT - count(*) AS duplicates, max(deliveries) > 1 AS any_duplicates FROM d")
def run_summary(spark, sf):
    return newest(spark, sf).agg(F.countDistinct("bucket").alias("buckets"), F.sum("deliveries").alias("raw"), (F.sum("deliveries") - F.count("*")).alias("duplicates"), F.bool_or(F.col("deliveries") > 1).alias("any_duplicates"))


# ---------------------------------------------------------------- scalar functions

@query("WITH p AS (SELECT page_id, url FROM pages) SELECT page_id, replace(replace(replace(replace(replace(replace(url, '%', '%25'), ':', '%3A'), '?', '%3F'), '=', '%3D'), '#', '%23'), '&', '%26') AS encoded FROM p")
def key_encode(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", C.encode_key(F.col("url")).alias("encoded"))


@query("WITH p AS (SELECT page_id, url FROM pages) SELECT page_id, url AS decoded FROM p")
def key_decode(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", C.decode_key(C.encode_key(F.col("url"))).alias("decoded"))


@query("WITH p AS (SELECT page_id, url FROM pages) SELECT page_id, '<redacted-key sha256:' || substr(sha256(url), 1, 12) || ' len=' || CAST(length(url) AS VARCHAR) || '>' AS redacted FROM p")
def key_redact(spark, sf):
    return spark.read.parquet(f"{sf}/pages.parquet").select("page_id", C.redact_key(F.col("url")).alias("redacted"))


@query("WITH p AS (SELECT event_id, ts FROM events) SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS watermark FROM p")
def watermark_format(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", C.watermark(F.col("ts")).alias("watermark"))


@query("WITH p AS (SELECT event_id, ts FROM events) SELECT event_id, ts - INTERVAL 2 HOUR AS window_start FROM p")
def watermark_subtract(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", C.subtract(F.col("ts"), 7200).alias("window_start"))


@query("WITH p AS (SELECT o_orderkey, o_orderstatus FROM orders) SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'plain' ELSE 'bucket-' || o_orderstatus END AS bucket FROM p")
def arn_to_bucket(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    arn = F.when(F.col("o_orderstatus") == "F", "plain").otherwise(F.concat(F.lit("arn:aws:s3:::bucket-"), "o_orderstatus"))
    return o.select("o_orderkey", C.bucket_of_arn(arn).alias("bucket"))


@query("SELECT bucket || ',' || key || ',' || coalesce(version_id, 'null') AS row FROM j WHERE type = 'view' AND NOT coalesce(is_delete_marker, false)")
def inventory_backfill(spark, sf):
    live_ = journal(spark, sf).where((F.col("object_tags")["type"] == "view") & ~F.coalesce("is_delete_marker", F.lit(False)))
    return live_.select(C.manifest_row(F.col("bucket"), F.col("key"), F.col("version_id")).alias("row"))


# ---------------------------------------------------------------- reports, metrics, runs

SAID = {"FAILED": ("failed to replicate",) * 2, "EXPIRED": ("were abandoned after the tracking window expired", "was abandoned after the tracking window expired"), "UNKNOWN": ("reported no replication status",) * 2, None: ("reported no replication status",) * 2,
        "PENDING": ("are still replicating", "is still replicating"), "GONE": ("were deleted before replication could be confirmed", "was deleted before replication could be confirmed"), "COMPLETE": ("replicated successfully",) * 2}
CLAUSES = ", ".join(f"CASE WHEN n{k} > 0 THEN format('{{:,}} ', n{k}) || CASE WHEN n{k} = 1 THEN '{one}' ELSE '{many}' END END" for k, (many, one) in enumerate(SAID.values()))
SOLE = ", ".join(f"CASE WHEN n{k} = n THEN CASE WHEN n = 1 THEN '{one}' ELSE '{many}' END END" for k, (many, one) in enumerate(SAID.values()))
COUNTS = ", ".join(f"count(CASE WHEN outcome IS NOT DISTINCT FROM {f"'{o}'" if o else 'NULL'} THEN 1 END) AS n{k}" for k, o in enumerate(SAID))


@query(TRACK + f""", c AS (SELECT bucket, count(*) AS n, {COUNTS} FROM rec GROUP BY bucket), t AS (SELECT *, n0 + n1 + n2 + n3 AS bad, format('{{:,}} object', n) || CASE WHEN n = 1 THEN '' ELSE 's' END AS noun FROM c)
SELECT bucket, n AS item_count, bad AS actionable, bucket || ': ' || noun || coalesce(' ' || coalesce({SOLE}), ' — ' || concat_ws('; ', {CLAUSES})) || '. '
 || CASE WHEN bad > 0 THEN format('Action needed: {{:,}} of {{:,}} did not replicate.', bad, n) WHEN n6 = n THEN 'No action needed.' ELSE 'No failures.' END || format(' {{:,}} objects remain in tracking.', 2000 + length(bucket)) AS summary,
 'S3 replication ' || bucket || ': ' || noun || CASE WHEN bad > 0 THEN ', action needed' ELSE ', no failures' END || format(', {{:,}} still tracking', 2000 + length(bucket)) AS subject FROM t""")
def report_summary(spark, sf):
    items = reconciled(spark, sf)
    left = items.select("bucket", (F.length("bucket") + 2000).alias("outstanding")).distinct()
    return P.outcome_summary(items, left)


@query(TRACK + """, g AS (SELECT bucket, rules, destinations, count(*) AS items, length(bucket || ',' || rules || ',' || destinations) + 20 AS size FROM rec GROUP BY bucket, rules, destinations),
o AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY rules, destinations) AS k FROM g),
c AS (WITH RECURSIVE r AS (SELECT bucket, k, rules, items, size, 0 AS chunk, 60 - size AS room FROM o WHERE k = 1
 UNION ALL SELECT o.bucket, o.k, o.rules, o.items, o.size, CASE WHEN o.size > r.room THEN r.chunk + 1 ELSE r.chunk END, CASE WHEN o.size > r.room THEN 60 - o.size ELSE r.room - o.size END
 FROM r JOIN o ON o.bucket = r.bucket AND o.k = r.k + 1) SELECT * FROM r)
SELECT chunk::BIGINT AS chunk, bucket, rules, items, size FROM c""")
def report_chunks(spark, sf):
    """Report groups of each bucket in chunks of a byte budget."""
    g = S.outcome_groups(reconciled(spark, sf)).withColumns({"rules": F.concat_ws(",", "rules"), "destinations": F.concat_ws(",", "destinations")})
    sized = g.withColumn("size", (F.octet_length(F.concat_ws(",", "bucket", "rules", "destinations")) + 20).cast("long"))
    return S.chunked_groups(sized, ["rules", "destinations"], 60).select("chunk", "bucket", "rules", "items", "size")


@query(TRACK + """, g AS (SELECT bucket, rules, count(*) AS n, min(key || '|' || coalesce(version_id, '')) AS first, strftime(min(tagged_at), '%Y-%m-%dT%H:%M:%S.%f+00:00') AS lo FROM rec GROUP BY bucket, rules, destinations)
SELECT bucket, 0::BIGINT AS chunk, sum(n)::BIGINT AS item_count, 2 AS format_version, 7::BIGINT AS outstanding, string_agg(rules || ':' || CAST(n AS VARCHAR), ';' ORDER BY first) AS groups, min(lo) AS earliest,
 (SELECT string_agg(o || ':' || CAST(k AS VARCHAR), ',' ORDER BY o) FROM (SELECT coalesce(outcome, 'null') AS o, count(*) AS k FROM rec WHERE rec.bucket = g.bucket GROUP BY 1)) AS outcome_counts, 'S3' AS kind FROM g GROUP BY bucket""")
def completion_report(spark, sf):
    """Report documents of all buckets, read back from their JSON text."""
    items = reconciled(spark, sf).withColumn("last_modified", F.lit(None).cast("timestamp_ntz"))
    left = items.select("bucket", F.lit(7).alias("outstanding")).distinct()
    d = P.completion_documents(items, left).withColumn("d", F.from_json("document", P.DOCUMENT))
    groups = F.array_join(F.transform("d.groups", lambda g: F.concat(F.array_join(g["matched_rules"], ","), F.lit(":"), g["count"].cast("string"))), ";")
    counts = F.array_join(F.array_sort(F.transform(F.map_entries("d.outcome_counts"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))), ",")
    earliest = F.array_min(F.transform("d.groups", lambda g: g["tagged_at_range"][0]))
    kind = F.when(F.contains("d.summary", F.lit("7 objects remain in tracking.")) & ~F.contains("document", F.lit("last_modified_range")), "S3")
    return d.select("bucket", "chunk", "d.item_count", "d.format_version", "d.outstanding", groups.alias("groups"), earliest.alias("earliest"), counts.alias("outcome_counts"), kind.alias("kind"))


ACTIVE = "SELECT d.bucket, count(*) AS ops_read, (SELECT count(*) FROM m WHERE m.bucket = d.bucket) AS matched, (SELECT count(*) FROM kept WHERE kept.bucket = d.bucket) AS submitted, count(CASE WHEN storage_class IN ('GLACIER', 'DEEP_ARCHIVE') THEN 1 END) AS archived FROM d GROUP BY d.bucket"


@query(f""", b AS ({ACTIVE}) SELECT bucket, unnest(['TaggingOperationsRead', 'MatchedObjects', 'BatchJobsSubmitted']) AS metric, unnest([ops_read, matched, submitted])::DOUBLE AS value FROM b WHERE ops_read + matched + submitted > 0
 UNION ALL SELECT bucket, 'ArchivedObjectsExcluded', archived::DOUBLE FROM b WHERE archived > 0 UNION ALL SELECT bucket, 'BucketErrors', 0 FROM b UNION ALL SELECT NULL, 'DisabledBuckets', 1""")
def metric_rows(spark, sf):
    kept = M.without_deleted(manifest(spark, sf), deletes(spark, sf))
    count = lambda df, name: df.groupBy("bucket").agg(F.count("*").alias(name))
    per = newest(spark, sf).groupBy("bucket").agg(F.count("*").alias("ops_read"), F.count_if(C.is_archived(F.col("storage_class"))).alias("archived"))
    per = per.join(count(matches(spark, sf), "matched"), "bucket", "left").join(count(kept, "submitted"), "bucket", "left").fillna(0).withColumn("errored", F.lit(0))
    return P.metric_rows(per, F.lit(1))


JOBS = "SELECT bucket, job_id, 'c' || CAST(streak AS VARCHAR) AS config_id, o_orderdate AS terminal_at, job_id % 9 = 0 AS merged FROM (SELECT *, o_orderkey % 5 AS streak, o_orderkey AS job_id, 'lake-' || CAST(o_custkey % 3 AS VARCHAR) AS bucket FROM orders)"


def jobs(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    k = F.col("o_orderkey")
    return o.select(F.concat(F.lit("lake-"), (F.col("o_custkey") % 3).cast("string")).alias("bucket"), k.alias("job_id"), F.concat(F.lit("c"), (k % 5).cast("string")).alias("config_id"), F.col("o_orderdate").alias("terminal_at"), (k % 9 == 0).alias("merged"))


@query(f"WITH q AS ({JOBS}) SELECT bucket, job_id, config_id FROM q WHERE NOT merged AND terminal_at + INTERVAL 1 HOUR < TIMESTAMP '1997-01-01' AND job_id % 4 <> 0 AND NOT (bucket = 'lake-1' AND config_id = 'c2')")
def overdue_reports(spark, sf):
    j = jobs(spark, sf)
    told = spark.createDataFrame([("lake-1", "c2")], "bucket string, config_id string")
    return P.overdue(j, j.where("job_id % 4 = 0").select("job_id"), told, ntz(datetime(1997, 1, 1))).select("bucket", "job_id", "config_id")


@query(f"WITH q AS ({JOBS}) SELECT bucket, job_id, config_id FROM q WHERE (bucket <> 'lake-2' AND job_id % 2 = 0) OR (bucket = 'lake-2' AND job_id % 2 = 1)")
def record_submissions(spark, sf):
    j = jobs(spark, sf).select("bucket", "job_id", "config_id")
    return S.record_submissions(j.where("job_id % 2 = 0"), j.where("bucket = 'lake-2' AND job_id % 2 = 1"))


@query("SELECT config_id, TIMESTAMP '2024-01-20' AS last_scan_at, count(*) AS last_scan_match_count FROM m GROUP BY config_id UNION ALL SELECT 'idle', TIMESTAMP '2024-01-20', 0")
def scan_record(spark, sf):
    found = matches(spark, sf).groupBy("config_id").agg(F.count("*").alias("matches"))
    return S.record_scans(spark.createDataFrame([("c0",), ("idle",)], "config_id string"), found, ntz(datetime(2024, 1, 20)))


@query("SELECT DISTINCT bucket, TIMESTAMP '2024-01-05' AS watermark FROM j WHERE bucket NOT IN (SELECT sb FROM state)")
def seeded_buckets(spark, sf):
    return S.seeded(journal(spark, sf).select("bucket").distinct(), state(spark), ntz(SINCE))


@query(f"WITH q AS ({JOBS}) SELECT job_id, terminal_at <= TIMESTAMP '1996-12-31 18:00:00' AS due FROM q")
def alert_due(spark, sf):
    return jobs(spark, sf).select("job_id", P.alert_due(F.col("terminal_at"), ntz(datetime(1997, 1, 1)), 21600).alias("due"))


# ---------------------------------------------------------------- rows, names and stored documents

@query("SELECT bucket, key, version_id FROM mf")
def manifest_parse(spark, sf):
    bucket, key, version = C.parse_manifest_row(F.col("row"))
    return M.rendered(manifest(spark, sf)).select(bucket.alias("bucket"), key.alias("key"), version.alias("version_id"))


@query("SELECT DISTINCT 'b_' || replace(bucket || '.v1', '.', '_') AS namespace, 'completion-reports/c' || substr(bucket, 6) || '/runs_' || bucket || '.csv/' AS prefix, hex(key || chr(0) || coalesce(version_id, chr(1))) AS item FROM mf")
def stored_names(spark, sf):
    prefix = C.report_prefix(F.concat(F.lit("c"), F.substring("bucket", 6, 9)), F.concat(F.lit("runs/"), "bucket", F.lit(".csv")))
    return manifest(spark, sf).select(C.namespace(F.concat("bucket", F.lit(".v1"))).alias("namespace"), prefix.alias("prefix"), F.hex(C.item_key(F.col("key"), F.col("version_id"))).alias("item")).distinct()


MARKS = """CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') WHEN 2 THEN strftime(ts, '%Y-%m-%d') WHEN 3 THEN '9999-12-31T23:59:59.000000Z' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || ' ' END"""


@query(f"WITH p AS (SELECT event_id, ts, {MARKS} AS mark FROM events) SELECT event_id, event_id % 5 IN (0, 1, 3) AS canonical, event_id % 5 = 0 OR (event_id % 5 = 1 AND ts <= TIMESTAMP '{MARK}' + INTERVAL 1 DAY) AS plausible FROM p")
def watermark_checks(spark, sf):
    k, mark = F.col("event_id") % 5, C.watermark(F.col("ts"))
    text = F.when(k == 0, "").when(k == 1, mark).when(k == 2, F.date_format("ts", "yyyy-MM-dd")).when(k == 3, "9999-12-31T23:59:59.000000Z").otherwise(F.concat(mark, F.lit(" ")))
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", C.is_canonical(text).alias("canonical"), C.is_plausible(text, ntz(MARK).cast("timestamp")).alias("plausible"))


@query("WITH p AS (SELECT event_id, props, event_type FROM events) SELECT event_id, CASE WHEN event_id % 6 < 3 THEN 'no tags' END AS error_reason, CASE WHEN event_id % 6 >= 3 THEN event_type END AS type FROM p")
def tags_decode(spark, sf):
    """Tags as JSON text: objects are maps; empty objects, arrays and broken texts are errors of their row."""
    k, text = F.col("event_id") % 6, F.to_json(F.struct(F.col("event_type").alias("type")))
    raw = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.lit("k").alias("key"), F.col("ts").alias("record_timestamp"), F.when(k == 0, "{}").when(k == 1, "[1]").when(k == 2, "{broken").otherwise(text).alias("tags"))
    good = J.validity(raw.withColumn("object_tags", C.tags_of_json(F.col("tags"))))
    return good.select("event_id", "error_reason", F.when(F.col("error_reason").isNull(), F.col("object_tags")["type"]).alias("type"))


@query("""WITH p AS (SELECT 'own-' || CAST(c_custkey AS VARCHAR) AS bucket, CASE WHEN c_custkey % 7 = 3 OR c_custkey % 19 = 0 THEN 'no configuration' WHEN c_custkey % 17 = 0 THEN 'no permission to read the configuration'
 WHEN c_custkey % 23 = 0 THEN 'unreadable configuration' WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 THEN 'no rule with tags' END AS reason FROM customer) SELECT * FROM p WHERE reason IS NOT NULL""")
def rule_skips(spark, sf):
    """Every customer as a bucket of its own: some without a document, some whose document could not be read, some without rules."""
    c = F.col("c_custkey")
    own = documents(spark, sf).withColumn("bucket", F.concat(F.lit("own-"), c.cast("string")))
    error = F.when(c % 19 == 0, "absent").when(c % 17 == 0, "denied").when(c % 23 == 0, "timeout")
    there = own.where(c % 7 != 3)
    read = there.withColumn("error", error)
    return R.skip_reports(own, read.select("bucket", "error"), R.derive(read.where("error IS NULL"), enabled_only=True))


STORED = """WITH q AS (SELECT o_orderkey AS job_id, 'lake-' || CAST(o_custkey % 3 AS VARCHAR) AS bucket, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000000Z') AS mark FROM orders) """


@query(STORED + """SELECT bucket || '/' || CAST(job_id AS VARCHAR) AS bucket, CASE job_id % 7 WHEN 0 THEN 'not an object' WHEN 1 THEN 'watermark is no text' WHEN 2 THEN 'watermark is not plausible' WHEN 3 THEN 'document of another bucket' END AS problem,
 CASE WHEN job_id % 7 > 3 THEN mark END AS watermark, job_id % 7 = 5 AS lease_discarded, CASE WHEN job_id % 7 = 6 THEN 'L' END AS lease_id, CASE WHEN job_id % 7 > 3 THEN (CASE WHEN job_id % 2 = 0 THEN 1 ELSE 0 END)::BIGINT END AS ids FROM q""")
def checkpoint_decode(spark, sf):
    """Stored documents of all shapes: broken ones are named, an untrusted lease is dropped, absent lists are empty."""
    k, name = F.col("o_orderkey") % 7, F.concat(F.lit("lake-"), (F.col("o_custkey") % 3).cast("string"), F.lit("/"), F.col("o_orderkey").cast("string"))
    mark = F.when(k == 1, "7").when(k == 2, '"9999-12-31T23:59:59.000000Z"').otherwise(F.concat(F.lit('"'), C.watermark(F.col("o_orderdate")), F.lit('"')))
    lease = F.lit(', "lease": {"lease_id": "L", "candidate_max_watermark": "%s", "acquired_at": "2024-01-01T00:00:00", "status": "IN_FLIGHT"}')
    more = F.when(k == 5, F.replace(lease, F.lit("%s"), F.lit("9999-12-31T23:59:59.000000Z"))).when(k == 6, F.replace(lease, F.lit("%s"), F.lit("2024-01-02T00:00:00.000000Z"))).otherwise("")
    ids = F.when(F.col("o_orderkey") % 2 == 0, ', "completion_processed_job_ids": ["j"], "unknown": 1').otherwise("")
    document = F.when(k == 0, "[1]").otherwise(F.concat(F.lit('{"source_bucket": "'), F.when(k == 3, "other").otherwise(name), F.lit('", "last_processed_watermark": '), mark, more, ids, F.lit("}")))
    read = D.decoded(spark.read.parquet(f"{sf}/orders.parquet").select(name.alias("bucket"), document.alias("document")), ntz(MARK).cast("timestamp"))
    # the row goes along with its document, so what was read again is compared without a join
    first = F.struct("problem", "watermark", "lease_discarded", "lease.lease_id").alias("first")
    again = D.decoded(D.encoded(read.select("*", first), "first"), ntz(MARK).cast("timestamp"), "first")
    same = F.col("watermark") == F.col("first.watermark")
    ids = F.when(same, F.size("completion_processed_job_ids").cast("long")).alias("ids")
    return again.select("bucket", "first.problem", "first.watermark", F.coalesce("first.lease_discarded", F.lit(False)).alias("lease_discarded"), "first.lease_id", ids)


@query(STORED + """SELECT job_id, CASE job_id % 5 WHEN 0 THEN '{"last_processed_watermark": "' || mark || '" , "n": 1.0, "deep": {"last_processed_watermark": "x", "lease": 1}, "lease": null}'
 WHEN 1 THEN '{ "other" : [1, {"lease": 2}], "last_processed_watermark": "' || mark || '", "lease": null }' WHEN 2 THEN '{"last_processed_watermark":"' || mark || '", "lease": null}'
 WHEN 4 THEN '{"last_processed_watermark": "' || mark || '", "lease": null}' END AS document FROM q""")
def document_overlay(spark, sf):
    """A checkpoint laid over stored documents: namesakes further down stay, absent members are added, a broken text is lost."""
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, '{"last_processed_watermark": "old" , "n": 1.0, "deep": {"last_processed_watermark": "x", "lease": 1}}').when(k == 1, '{ "other" : [1, {"lease": 2}] }').when(k == 3, '{"lease": ').when(k == 4, "{}")
    members = D.checkpoint_members(C.watermark(F.col("o_orderdate")), F.lit(None).cast(D.LEASE))
    return spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("job_id"), D.with_members(text, members).alias("document"))


@query("SELECT bucket, lid_hex, watermark, pos FROM (SELECT bucket, lid AS lid_hex, record_timestamp AS watermark, row_number() OVER (PARTITION BY bucket ORDER BY record_timestamp, lid) AS pos FROM d)")
def window_refs_order(spark, sf):
    """Processed references of each bucket in the order in which they are stored: by time, then by id."""
    lid = F.concat_ws("|", "bucket", "key", F.coalesce("version_id", F.lit("<null>")), F.col("object_tags")["type"], F.coalesce(F.col("object_tags")["k"], F.lit("")))
    return S.ordered_references(newest(spark, sf).select("bucket", lid.alias("lid"), "record_timestamp")).select("bucket", F.col("lid").alias("lid_hex"), F.col("record_timestamp").alias("watermark"), "pos")


# ---------------------------------------------------------------- tracking

JOB_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'Failed' WHEN 'O' THEN 'Complete' ELSE 'Active' END"


@query(f"WITH q AS (SELECT o_orderkey AS job_id, {JOB_STATUS} AS status FROM orders) SELECT job_id, status FROM q WHERE status <> 'Active' AND job_id % 3 <> 0")
def terminal_unmerged(spark, sf):
    j = outcomes(spark, sf).select("job_id", "status")
    return T.unmerged_jobs(j, j.where("job_id % 3 = 0").select("job_id"))


@query(REPORT + """, s AS (SELECT * FROM mf WHERE length(key) % 2 = 0) SELECT r.bucket, r.key, r.version_id, r.sequence_number, s.tagged_at, s.rules FROM rep r LEFT JOIN s ON s.bucket = r.bucket AND s.key = r.key AND s.version_id IS NOT DISTINCT FROM r.version_id""")
def stored_lookup(spark, sf):
    stored = manifest(spark, sf).where(F.length("key") % 2 == 0)
    return T.with_stored(parsed(spark, sf), stored).select("bucket", "key", "version_id", "sequence_number", "tagged_at", F.concat_ws(",", "rules").alias("rules")).withColumn("rules", F.when(F.col("rules") != "", F.col("rules")))


@query("SELECT bucket, key, version_id, CASE WHEN length(key) % 2 = 0 THEN 'first' ELSE 'second' END AS tagged_at FROM mf WHERE length(key) % 2 = 0 OR length(key) % 3 <> 0")
def side_insert(spark, sf):
    m = manifest(spark, sf).select("bucket", "key", "version_id")
    stored, fresh = m.where(F.length("key") % 2 == 0).withColumn("tagged_at", F.lit("first")), m.where(F.length("key") % 3 != 0).withColumn("tagged_at", F.lit("second"))
    return T.inserted_if_absent(stored, fresh)


@query(TRACK + "SELECT bucket, key, version_id, CASE WHEN state = 'PENDING' AND outcome IS NOT NULL THEN 'RESOLVED' ELSE state END AS state, CASE WHEN state = 'PENDING' THEN outcome END AS outcome FROM rec")
def resolutions_applied(spark, sf):
    found = reconciled(spark, sf).select("bucket", "key", "version_id", "outcome", ntz(datetime(2024, 1, 20)).alias("resolved_at"))
    items = tracked(spark, sf).withColumns({"outcome": F.lit(None).cast("string"), "resolved_at": F.lit(None).cast("timestamp_ntz")})
    return T.resolved(items, found).select("bucket", "key", "version_id", "state", "outcome")


@query(TRACK + f"SELECT bucket, key, version_id, state FROM items WHERE NOT ({PUB})")
def published_removed(spark, sf):
    return T.without_published(tracked(spark, sf), publishable(spark, sf)).select("bucket", "key", "version_id", "state")


@query(TRACK + "SELECT bucket, key, version_id FROM items WHERE state = 'RESOLVED' AND bucket <> 'lake-1' AND (bucket <> 'lake-2' OR tagged_at < TIMESTAMP '2024-01-10')")
def publishable_by_scans(spark, sf):
    """Two configs for each object: one of its bucket, and one that is always quiet."""
    config = F.struct(F.lit("j").alias("job_id"), F.col("tagged_at").alias("manifest_at"), F.lit(True).alias("confirmed"))
    items = tracked(spark, sf).withColumn("configs", F.create_map(F.col("bucket"), config, F.lit("quiet"), config))
    late = datetime(2030, 1, 1)
    scans = [("lake-0", late, 0), ("lake-1", late, 4), ("lake-2", datetime(2024, 1, 10), 0), ("quiet", late, 0)]
    return T.publishable(items, spark.createDataFrame(scans, "config_id string, last_scan_at timestamp_ntz, last_scan_match_count long")).select("bucket", "key", "version_id")


DIAGNOSES = """, e AS (SELECT bucket AS job_id, error_code, sequence_number, CASE WHEN CAST(sequence_number AS BIGINT) % 2 = 0 THEN 'm' || sequence_number END AS message FROM rep WHERE error_code IS NOT NULL),
f AS (SELECT job_id, error_code, count(*) AS n, arg_min(coalesce(message, '-'), sequence_number) AS message FROM e GROUP BY job_id, error_code)
SELECT job_id, error_code, n, nullif(message, '-') AS message, CASE error_code WHEN 'AccessDenied' THEN 'the job''s role lacks a permission' ELSE 'a task failed' || CASE WHEN message <> '-' THEN ': ' || message ELSE '' END END AS cause FROM f"""


@query(REPORT + DIAGNOSES)
def report_diagnoses(spark, sf):
    seq = F.col("sequence_number").cast("long")
    rows = parsed(spark, sf).select(F.col("bucket").alias("job_id"), F.col("sequence_number").alias("position"), "error_code", F.when(seq % 2 == 0, F.concat(F.lit("m"), "sequence_number")).alias("result_message"))
    return T.error_diagnoses(rows)


@query(f"WITH q AS ({JOBS}) SELECT DISTINCT bucket, config_id FROM q WHERE job_id % 3 < 2 AND config_id <> 'c4'")
def alert_suppression(spark, sf):
    j = jobs(spark, sf)
    return T.alerted(j.where("job_id % 3 = 0"), j.where("job_id % 3 = 1"), j.where("config_id = 'c4'"))


@query(f"WITH q AS ({JOBS}) SELECT job_id, job_id % 2 = 0 OR merged AS report_diagnosed FROM q")
def report_marks(spark, sf):
    j = jobs(spark, sf)
    return T.diagnosed(j.withColumn("report_diagnosed", F.col("merged")), j.where("job_id % 2 = 0")).select("job_id", "report_diagnosed")


@query("WITH p AS (SELECT c_custkey AS bucket FROM customer) SELECT bucket FROM p WHERE bucket % 5 NOT IN (1, 2)")
def enabled_buckets(spark, sf):
    """Disabled buckets and those whose flag cannot be read are left out; no flag is enabled."""
    c = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("bucket"))
    flags = c.where("bucket % 5 <> 0").select("bucket", (F.col("bucket") % 5 == 1).alias("disabled"), (F.col("bucket") % 5 != 2).alias("readable"))
    return T.enabled(c, flags)


@query("WITH f AS (SELECT o_orderkey AS k, 'run-' || CAST(o_orderkey AS VARCHAR) AS run, o_orderdate AS modified FROM orders) SELECT run, modified FROM f WHERE modified < TIMESTAMP '1996-12-25' AND k % 7 <> 0 AND k % 11 <> 0")
def doomed_runs(spark, sf):
    """Run folders older than a week that neither a window nor a part of the items is in; paths elsewhere hold nothing."""
    o = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("k"), F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run"), F.col("o_orderdate").alias("modified"))
    path = lambda root, tail: F.concat(F.lit(root), F.col("run"), F.lit(tail)).alias("path")
    named = o.where("k % 7 = 0").select(path("/lake/runs/", "/window")).unionByName(o.where("k % 11 = 0").select(path("/lake/runs/", "/items/part=3"))).unionByName(o.select(path("/lake/others/", "/window")))
    return doomed(o, named, "/lake/runs", ntz(datetime(1997, 1, 1)), 7 * DAY).select("run", "modified")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import tagflow.plans.jobs
    import tagflow.plans.streams  # noqa: F401 - both register their queries
    from tagflow.streaming.journal import stream_dedup_within_watermark

    return QUERIES | {"stream_dedup_within_watermark": stream_dedup_within_watermark}


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
