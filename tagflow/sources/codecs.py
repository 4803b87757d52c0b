"""Stored state documents (JSON text, one for each bucket) as rows, and back.

What is stored may have been written by others: wrong types and marks that no run could have
written make a document unusable, an untrusted lease alone is dropped, and parts that are not there have defaults.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.functions.columns import is_plausible

# The members of stored documents.
LEASE = "struct<lease_id:string,candidate_max_watermark:string,acquired_at:string,status:string>"
WINDOW = "array<struct<logical_operation_id:string,watermark:string>>"
SUBMISSION = "struct<replication_config_id:string,source_bucket:string,job_id:string,manifest_key:string,submitted_at:string,status:string,watermark_low:string,watermark_high:string,consecutive_failures:int,report_diagnosed:boolean>"
CONFIG = "struct<replication_config_id:string,job_id:string,manifest_generated_at:string,bops_confirmed:boolean>"
ITEM = f"struct<object_key:string,version_id:string,configs:map<string,{CONFIG}>,state:string,resolved_at:string,replication_outcome:string>"
SCAN = "struct<replication_config_id:string,last_scan_at:string,last_scan_match_count:long>"
DOCUMENT = f"""source_bucket string, last_processed_watermark string, lease {LEASE}, processed_window {WINDOW}, submission_records array<{SUBMISSION}>,
completion_items map<string,{ITEM}>, completion_processed_job_ids array<string>, scan_states array<{SCAN}>, completion_report_alerted_configs array<string>"""
LEASE_STATUS = ["IN_FLIGHT"]
NAMES = ["lease", "processed_window", "submission_records", "completion_items", "completion_processed_job_ids", "scan_states", "completion_report_alerted_configs"]


def _kind(name: str) -> Column:
    """What a member of the document is: STRING, BIGINT, OBJECT<...>, VOID; null where it is not there."""
    return F.schema_of_variant(F.try_variant_get("parsed", f"$.{name}", "variant"))


def decoded(documents: DataFrame, now: Column, *kept: str) -> DataFrame:
    """bucket, problem, watermark, lease, lease_discarded and the stored lists of `documents` (bucket, document).

    A document with a `problem` has nulls elsewhere; absent lists are empty. A lease holds back whatever lies up to
    its mark, so one that does not have the form that is written, or a mark far ahead, counts as none. Columns named in `kept` stay beside their document.
    """
    # one row each: what is parsed here is not parsed again wherever it is used below
    both = F.struct(F.try_parse_json("document").alias("parsed"), F.from_json("document", DOCUMENT).alias("d"))
    read = documents.select("bucket", "document", *kept, F.inline(F.array(both)))
    mark = F.col("d.last_processed_watermark")
    problem = (
        F.when(F.col("parsed").isNull() | ~F.schema_of_variant("parsed").startswith("OBJECT"), "not an object")
        .when(F.coalesce(_kind("source_bucket") != "STRING", F.lit(True)), "source_bucket is no text")
        .when(F.col("d.source_bucket") != F.col("bucket"), "document of another bucket")
        .when(F.coalesce(_kind("last_processed_watermark") != "STRING", F.lit(True)), "watermark is no text")
        .when(~is_plausible(mark, now), "watermark is not plausible")
    )
    lease = F.col("d.lease")
    strings = [F.coalesce(_kind(f"lease.{k}") == "STRING", F.lit(False)) for k in ("lease_id", "candidate_max_watermark")]
    trusted = strings[0] & strings[1] & F.try_to_timestamp(lease["acquired_at"]).isNotNull() & lease["status"].isin(LEASE_STATUS) & is_plausible(lease["candidate_max_watermark"], now)
    trusted = F.coalesce(trusted, F.lit(False))
    there = F.coalesce(_kind("lease") != "VOID", F.lit(False))
    judged = F.struct(problem.alias("problem"), trusted.alias("trusted"), there.alias("there"))
    good = read.select("bucket", "d", *kept, F.inline(F.array(judged)))
    sound = F.col("problem").isNull()
    lists = [F.when(sound, F.coalesce(F.col(f"d.{n}"), F.from_json(F.lit("{}" if n == "completion_items" else "[]"), _type(n)))).alias(n) for n in NAMES if n != "lease"]
    return good.select("bucket", "problem", F.when(sound, mark).alias("watermark"), F.when(sound & F.col("trusted"), lease).alias("lease"), (sound & F.col("there") & ~F.col("trusted")).alias("lease_discarded"), *lists, *kept)


def _type(name: str) -> str:
    return {"processed_window": WINDOW, "submission_records": f"array<{SUBMISSION}>", "completion_items": f"map<string,{ITEM}>", "completion_processed_job_ids": "array<string>", "scan_states": f"array<{SCAN}>", "completion_report_alerted_configs": "array<string>"}[name]


def encoded(states: DataFrame, *kept: str) -> DataFrame:
    """bucket and document (JSON text) of rows as `decoded` gives them; lists of ids are sorted, so equal states are equal texts. Columns named in `kept` stay; with them a row that has a problem stays too, without a document."""
    out = {n: F.col(n) for n in NAMES}
    for n in ("completion_processed_job_ids", "completion_report_alerted_configs", "processed_window"):
        out[n] = F.array_sort(n)
    members = [F.col("bucket").alias("source_bucket"), F.col("watermark").alias("last_processed_watermark"), *(c.alias(n) for n, c in out.items())]
    sound = F.col("problem").isNull()
    return (states if kept else states.where(sound)).select("bucket", F.when(sound, F.to_json(F.struct(*members))).alias("document"), *kept)


def _members(text: str) -> list[tuple[str, int, int]]:
    """Names and places of the values of an object's own members; ValueError where the text is no object."""
    blank, value = re.compile(r"[ \t\n\r]*"), json.JSONDecoder()

    def after(at: int) -> int:
        return blank.match(text, at).end()

    at, found = after(0), []
    if text[at : at + 1] != "{":
        raise ValueError("no object")
    at = after(at + 1)
    while text[at : at + 1] != "}":
        name, at = value.raw_decode(text, at)
        at = after(at)
        if not isinstance(name, str) or text[at : at + 1] != ":":
            raise ValueError("no member")
        begin = after(at + 1)
        _, end = value.raw_decode(text, begin)
        found.append((name, begin, end))
        at = after(end)
        if text[at : at + 1] == ",":
            at = after(at + 1)
        elif text[at : at + 1] != "}":
            raise ValueError("no end")
    if after(at + 1) != len(text):
        raise ValueError("more than an object")
    return found


def _merged(text: str | None, patch: str | None) -> str | None:
    """`text` with the members of `patch`; every other byte of it stays."""
    if patch is None:
        return text
    if text is None:
        return patch
    try:
        have, fresh = _members(text), {n: patch[b:e] for n, b, e in _members(patch)}
    except (ValueError, RecursionError):
        return None
    out, at = [], 0
    for name, begin, end in have:
        if name in fresh:
            out += [text[at:begin], fresh[name]]
            at = end
    names = {n for n, _, _ in have}
    more = [f"{json.dumps(n)}: {v}" for n, v in fresh.items() if n not in names]
    if more:
        close = text.rindex("}")
        head = text[at:close].rstrip(" \t\n\r")
        tail = text[at:close][len(head) :]
        out += [head, ", " if have else "", ", ".join(more), tail, text[close:]]
    else:
        out.append(text[at:])
    return "".join(out)


def with_members(document: Column, members: Column) -> Column:
    """A stored document with the members of another JSON object (text): those it has get their new value, others are added.

    Only members of the object itself are meant, not namesakes further down; all that is not replaced stays as it is, byte
    for byte. No document: the members alone; a text that is no object: null, as nothing can be kept of it.
    """

    @F.pandas_udf("string")
    def merge(text: pd.Series, patch: pd.Series) -> pd.Series:
        return pd.Series([_merged(t if isinstance(t, str) else None, p if isinstance(p, str) else None) for t, p in zip(text, patch, strict=True)], dtype=object)

    return merge(document, members)


def overlaid(document: Column, watermark: Column) -> Column:
    """A stored document with another mark; all other members, known or not, stay as they are."""
    return with_members(document, F.to_json(F.struct(watermark.alias("last_processed_watermark"))))


def checkpoint_members(watermark: Column, lease: Column) -> Column:
    """The members that a checkpoint owns, as JSON text; no lease is a null that is written."""
    plain = F.to_json(F.struct(watermark.alias("last_processed_watermark")))
    return F.concat(F.substr(plain, F.lit(1), F.length(plain) - 1), F.lit(', "lease": '), F.coalesce(F.to_json(lease), F.lit("null")), F.lit("}"))


def state_file(bucket: Column) -> Column:
    """Name of a bucket's stored document."""
    return F.concat(F.lit("state/"), bucket, F.lit(".json"))
