"""Scalar functions as Column expressions; none needs a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WATERMARK = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
# The archived storage classes, and the accepted event-time formats.
ARCHIVED = ["GLACIER", "DEEP_ARCHIVE"]
TIME_FORMATS = ["yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]' UTC'", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]'Z'"]


def identity(bucket: Column, key: Column, version: Column, tags: Column) -> Column:
    """Logical operation id: a null version and an empty one differ, the order of tags does not matter."""
    canonical = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(tags))))
    digest = F.substring(F.sha2(F.coalesce(canonical, F.lit("{}")), 256), 1, 16)
    return F.concat_ws("\x00", bucket, key, F.coalesce(version, F.lit("\x01null-version")), digest)


def encode_key(key: Column) -> Column:
    """Percent-encode a key, keeping slashes."""
    out = F.url_encode(key)
    for found, put in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(found), F.lit(put))
    return out


def decode_key(key: Column) -> Column:
    """Percent-decode; a plus is a plus, and a malformed key stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(key, F.lit("+"), F.lit("%2B"))), key)


def redact_key(key: Column) -> Column:
    return F.format_string("<redacted-key sha256:%s len=%d>", F.substring(F.sha2(key, 256), 1, 12), F.length(key))


def manifest_row(bucket: Column, key: Column, version: Column) -> Column:
    return F.concat_ws(",", bucket, encode_key(key), F.coalesce(version, F.lit("null")))


def bucket_of_arn(arn: Column) -> Column:
    return F.when(arn.rlike("^arn:.*:::.+"), F.substring_index(arn, ":::", -1)).otherwise(arn)


def is_archived(storage_class: Column) -> Column:
    """Null stays in; case and blanks around do not matter."""
    return F.coalesce(F.upper(F.trim(storage_class)).isin(ARCHIVED), F.lit(False))


def watermark(ts: Column) -> Column:
    """Fixed-width text whose order is that of time; a null is the epoch, the empty text."""
    return F.coalesce(F.date_format(ts, WATERMARK), F.lit(""))


def parse_watermark(text: Column) -> Column:
    return F.when(text != "", F.try_to_timestamp(text, F.lit(WATERMARK)))


def subtract(ts: Column, seconds: int) -> Column:
    """Event time less a lookback; the epoch (null) stays; a negative lookback is an error."""
    if seconds < 0:
        raise ValueError("the lookback is negative")
    return ts - F.make_dt_interval(secs=F.lit(float(seconds)))


def parse_event_time(text: Column) -> Column:
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in TIME_FORMATS))


def http_status(text: Column) -> Column:
    return F.coalesce(F.trim(text).rlike("^[1-5][0-9]{2}$"), F.lit(False))


def status_and_error(a: Column, b: Column) -> tuple[Column, Column]:
    """Two columns that come in either order: the one that looks like a status, and the other as error code."""
    swapped = ~http_status(a) & http_status(b)
    pick = lambda x, y: F.when(swapped, y).otherwise(x)
    blank = lambda x: F.when(F.trim(x) != "", F.trim(x))
    return blank(pick(a, b)), blank(pick(b, a))


def parse_manifest_row(row: Column) -> tuple[Column, Column, Column]:
    """Bucket, key and version of a rendered manifest row; an empty or literal `null` version is the null version."""
    version = F.substring_index(row, ",", -1)
    front = F.substr(row, F.lit(1), F.greatest(F.length(row) - F.length(version) - 1, F.lit(0)))
    bucket = F.substring_index(front, ",", 1)
    key = F.substr(front, F.length(bucket) + 2)
    return bucket, decode_key(key), F.when(~version.isin("", "null"), version)


def item_key(key: Column, version: Column) -> Column:
    """Key of a tracked object; the null version and an empty one differ."""
    return F.concat(key, F.lit("\x00"), F.coalesce(version, F.lit("\x01")))


def namespace(bucket: Column) -> Column:
    """Journal namespace of a bucket."""
    return F.concat(F.lit("b_"), F.replace(bucket, F.lit("."), F.lit("_")))


def report_prefix(config_id: Column, manifest_key: Column) -> Column:
    """Folder of a job's report, known before the job has an id."""
    return F.concat(F.lit("completion-reports/"), config_id, F.lit("/"), F.replace(manifest_key, F.lit("/"), F.lit("_")), F.lit("/"))


def is_canonical(text: Column) -> Column:
    """The text is a watermark as `watermark` writes it (the empty text is the epoch)."""
    return F.coalesce((text == "") | (F.date_format(parse_watermark(text), WATERMARK) == text), F.lit(False))


def is_plausible(text: Column, now: Column) -> Column:
    """Canonical, and at most a day ahead of `now`: a stored mark far ahead would stop a bucket without a word."""
    return is_canonical(text) & F.coalesce((text == "") | (parse_watermark(text) <= now + F.make_dt_interval(days=F.lit(1))), F.lit(False))


def tags_of_json(text: Column) -> Column:
    """A tag map from its JSON text; null where that is no object."""
    return F.when(F.ltrim(text).startswith("{"), F.from_json(text, "map<string,string>"))
