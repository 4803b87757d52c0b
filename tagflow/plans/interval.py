"""One interval over all buckets: window, deduplication, eligibility, match, manifest, submission, state.

Buckets are a column, so one plan serves them all; where it fails, the buckets are run in halves, until what
cannot be read stands alone. What passes through the driver is one row for each configured bucket (at
most `settings.MAX_BUCKETS`); operations, manifests and the window of processed ids stay in tables.
State is one versioned document that lists the generations of the processed window, so marks and window change
together or not at all; a lease in it keeps other runs off what this one is about to submit.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.operators import journal as J
from tagflow.operators import manifest as M
from tagflow.operators import preflight as B
from tagflow.operators import rules as R
from tagflow.operators import state as S
from tagflow.operators.settings import Settings, should_continue
from tagflow.sources import processed as W
from tagflow.sources.sinks import StateConflict, StateStore, write_envelope, write_manifests

#: Answers of a submission: taken, worth another try, or never going to work.
SUBMITTED, TRANSIENT, PERMANENT = "submitted", "transient", "permanent"
STATE = "interval"
#: How far ahead of the clock a stored mark may be.
SKEW = timedelta(hours=24)
Submit = Callable[[str, dict, str], str]


@dataclass
class Outcome:
    """What a run did, per bucket: manifest rows, answers of the submissions, new marks, matched keys counted, and errors of buckets that failed.

    `overshoot` is the number of rows read above the cap, because rows of one time stay together.
    """

    manifests: dict[str, dict] = field(default_factory=dict)
    answers: dict[str, str] = field(default_factory=dict)
    marks: dict[str, datetime | None] = field(default_factory=dict)
    disabled: list[str] = field(default_factory=list)
    errors: dict[str, str] = field(default_factory=dict)
    scans: dict[str, int] = field(default_factory=dict)
    capped: bool = False
    overshoot: int = 0

    @property
    def progressed(self) -> bool:
        return SUBMITTED in self.answers.values()

    def add(self, other: Outcome) -> None:
        """Take in what a run of other buckets did."""
        for name in ("manifests", "answers", "marks", "errors", "scans"):
            getattr(self, name).update(getattr(other, name))
        self.disabled = sorted({*self.disabled, *other.disabled})
        self.capped |= other.capped
        self.overshoot += other.overshoot


def _time(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def lease_mark(entry: dict) -> datetime | None:
    """Mark of a bucket's lease; one that does not have the form that is written, or lies far ahead, counts as none."""
    lease = entry.get("lease")
    try:
        mark, taken = _time(lease["mark"]), _time(lease["acquired_at"])
        trusted = isinstance(lease["id"], str) and mark is not None and taken is not None and mark <= _now() + SKEW
    except (KeyError, TypeError, ValueError):
        return None
    return mark if trusted else None


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def _marks(spark: SparkSession, entries: dict[str, dict]) -> DataFrame:
    rows = [(b, _time(e.get("watermark")), lease_mark(e)) for b, e in entries.items()]
    return spark.createDataFrame(rows, "bucket string, watermark timestamp_ntz, lease_mark timestamp_ntz")


def _token(bucket: str, entry: dict, envelope: dict) -> str:
    """The same for the same manifest from the same mark, so that a sink knows a second hand-over of it."""
    return hashlib.md5(json.dumps([bucket, entry.get("watermark"), [f["MD5checksum"] for f in envelope["files"]]]).encode()).hexdigest()


def seed(store: StateStore, buckets: list[str], start: datetime) -> None:
    """Give new buckets a first mark; those with state keep theirs."""
    document, version = store.read(STATE)
    document = document or {"buckets": {}, "window": None}
    fresh = [b for b in buckets if b not in document["buckets"]]
    if fresh:
        document["buckets"] |= {b: {"watermark": start.isoformat()} for b in fresh}
        store.write(STATE, document, version)


#: Statuses of jobs that have ended.
ENDED = ("Complete", "Failed", "Cancelled")


def outcomes_of(spark: SparkSession, store: StateStore, statuses: DataFrame) -> DataFrame:
    """Outcomes for the next run: `statuses` (job_id, status, tasks_succeeded, tasks_failed) of the jobs that the state has on record.

    Jobs that are not on record, or have not ended, have no row; of several statuses of one job all count.
    """
    document, _ = store.read(STATE)
    held = [(b, e["submission"]) for b, e in (document or {"buckets": {}})["buckets"].items() if e.get("submission")]
    rows = [(b, sent["job"], int(sent.get("failures", 0)), sent.get("low") or "") for b, sent in held]  # one row a bucket
    known = spark.createDataFrame(rows, "bucket string, sent_job string, consecutive_failures int, watermark_low string")
    ended = statuses.where(F.col("status").isin(*ENDED))
    return ended.join(F.broadcast(known), F.col("job_id") == F.col("sent_job")).select("bucket", "job_id", "status", "tasks_succeeded", "tasks_failed", "consecutive_failures", "watermark_low")


def recovered(entries: dict[str, dict], outcomes: DataFrame | None, threshold: int) -> dict[str, dict]:
    """Entries with marks set back to the lowest start of failed jobs, and buckets over the threshold disabled.

    A submission on record is dropped where its job ended well; a failed one stays until another takes its place.
    """
    if outcomes is None:
        return entries
    plan = S.recovery_plan(outcomes.where(F.col("bucket").isin(list(entries)) & F.col("status").isin(*ENDED)), threshold)
    out = dict(entries)
    for r in plan.select("bucket", F.regexp_replace("rollback_to", "Z$", "").alias("low"), "consecutive_failures", "disable").collect():  # one row a bucket
        entry = {k: v for k, v in out[r.bucket].items() if k != "submission" or r.consecutive_failures}
        if r.low and _time(entry.get("watermark")) and _time(r.low) < _time(entry["watermark"]):
            entry = entry | {"watermark": r.low}
        failures = {"failures": r.consecutive_failures} if r.consecutive_failures else {}
        out[r.bucket] = entry | failures | ({"disabled": True} if r.disable else {})
    return out


def run_interval(spark: SparkSession, journal: DataFrame, rules: DataFrame, store: StateStore, submit: Submit, folder: str, settings: Settings, outcomes: DataFrame | None = None, only: list[str] | None = None, count_scans: bool = False) -> Outcome:
    """Run one interval for every enabled bucket of the stored state (of those in `only`, if it is given).

    `submit(bucket, envelope, token)` hands a bucket's manifest on; an exception counts as
    TRANSIENT. A bucket's mark and window move only after SUBMITTED, and the submission (job, mark it started from, objects,
    failures before it) is put on record in the same write. `folder` is shared storage. The cap
    counts rows past the marks, over all buckets, and rows of one time stay together. `count_scans` adds the
    number of keys that the rules match in the window, before deduplication. The lease is given up on every way out.
    """
    document, version = store.read(STATE)
    document = document or {"buckets": {}, "window": None}
    chosen = {b: e for b, e in document["buckets"].items() if only is None or b in only}
    entries = recovered(chosen, outcomes, settings.failure_threshold) if chosen else {}
    enabled = {b: e for b, e in entries.items() if not e.get("disabled")}
    result = Outcome(disabled=[b for b in entries if b not in enabled])
    if not enabled:
        if entries != chosen:
            store.write(STATE, document | {"buckets": document["buckets"] | entries}, version)
        return result
    run = f"{folder}/{uuid.uuid4()}"
    marks = _marks(spark, enabled)
    known = [_time(e.get("watermark")) for e in enabled.values()]
    since = None if None in known else min(known)
    lower = None if since is None else F.lit((since - timedelta(seconds=settings.lookback_s)).isoformat(" ")).cast("timestamp_ntz")
    journal = journal.where(F.col("bucket").isin(list(enabled)))
    window = J.window(journal, lower)
    fresh = J.after_marks(window, marks)
    boundary = J.row_cap_boundary(fresh, settings.row_cap).first()
    result.capped = boundary is not None
    if result.capped:
        until = F.lit(boundary[0].isoformat(" ")).cast("timestamp_ntz")
        window = window.where(F.col("record_timestamp") <= until)
        result.overshoot = fresh.where(F.col("record_timestamp") <= until).count() - settings.row_cap
    if count_scans:
        result.scans = dict.fromkeys(enabled, 0) | {r.bucket: r.matches for r in B.matched_keys(window, rules).collect()}  # one row a bucket
    done = J.until_marks(W.read(spark, document["window"]), marks)
    J.eligible(J.latest(J.validity(window).where("error_reason IS NULL").drop("error_reason")), marks, done, settings.lookback_s).write.parquet(f"{run}/eligible")
    eligible = spark.read.parquet(f"{run}/eligible")
    high = {r.bucket: r.high_water_mark for r in J.high_water_mark(eligible).collect()}  # one row a bucket
    leased = {b: {"id": run, "mark": high[b].isoformat(), "acquired_at": _now().isoformat()} for b in high}
    plain = {b: {k: v for k, v in e.items() if k != "lease" or lease_mark(e)} for b, e in document["buckets"].items()}
    if leased:
        version = store.write(STATE, document | {"buckets": plain | {b: plain[b] | {"lease": lease} for b, lease in leased.items()}}, version)
    after, jobs = plain, {}
    try:
        live = J.without_archived(eligible)
        M.without_deleted(M.union(R.match(live, rules)), J.permanent_deletes(journal, lower)).write.parquet(f"{run}/kept")
        kept = spark.read.parquet(f"{run}/kept")
        result.manifests = write_manifests(M.rendered(kept), f"{run}/manifest", settings.manifest_file_rows)
        for bucket, envelope in result.manifests.items():
            envelope["checksum"] = write_envelope(spark, f"{run}/envelopes/{bucket}", bucket, folder, int(_now().timestamp() * 1000), envelope["files"])
            token = _token(bucket, entries[bucket], envelope)
            jobs[bucket] = {"job": token, "low": entries[bucket].get("watermark"), "objects": envelope["object_count"], "failures": entries[bucket].get("failures", 0), "at": _now().isoformat()}
            try:
                result.answers[bucket] = submit(bucket, envelope, token)
            except Exception:  # noqa: BLE001 - whatever a sink raises, the bucket is tried again in the next run
                result.answers[bucket] = TRANSIENT
        moved = {b: _after(document["buckets"][b], plain[b], entries[b], result.answers.get(b), high.get(b), settings, jobs.get(b)) for b in entries}
        result.marks = {b: _time(e.get("watermark")) for b, e in moved.items()}
        result.disabled = [b for b, e in moved.items() if e.get("disabled")]
        sent = [b for b, a in result.answers.items() if a == SUBMITTED]
        if sent:
            refs = M.references(live, kept.where(F.col("bucket").isin(sent))).select("bucket", "lid", F.col("record_timestamp").alias("watermark"))
            size = sum(result.manifests[b]["object_count"] for b in sent)
            before = {b: (_time(document["buckets"][b].get("watermark")), _time(entries[b].get("watermark"))) for b in sent}
            set_back = {b: now for b, (was, now) in before.items() if was and now and now < was}
            document = document | {"window": W.append(spark, document["window"], f"{folder}/processed", refs, size, set_back, _kept_after(plain | moved, settings))}
        after = plain | moved
    finally:
        if leased or after != document["buckets"]:
            store.write(STATE, document | {"buckets": after}, version)
    return result


def _kept_after(entries: dict[str, dict], settings: Settings) -> date | None:
    """First day of the processed window over all buckets; None where one has no mark, and so needs all."""
    marks = [_time(e.get("watermark")) for e in entries.values()]
    return None if None in marks else (min(marks) - timedelta(seconds=settings.lookback_s)).date()


def _after(stored: dict, plain: dict, entry: dict, answer: str | None, high: datetime | None, settings: Settings, job: dict | None) -> dict:
    """A bucket's entry after a run: its mark moves on with SUBMITTED alone, and one set back holds for that run alone."""
    kept = {k: v for k, v in entry.items() if k not in ("lease", "failures")} | ({"lease": plain["lease"]} if "lease" in plain else {})
    if answer == SUBMITTED:
        mark = max(filter(None, (_time(entry.get("watermark")), high)))
        return {k: v for k, v in kept.items() if k != "streak"} | {"watermark": mark.isoformat(), "submission": job}
    kept = kept | {"watermark": stored.get("watermark")}
    if answer == PERMANENT:
        streak = int(kept.get("streak", 0)) + 1
        return kept | {"streak": streak} | ({"disabled": True} if streak >= settings.failure_threshold else {})
    return kept


def isolated(run: Callable[[list[str]], Outcome], buckets: list[str]) -> Outcome:
    """`run` for all buckets at once; where it fails, for the halves of them, until a bucket that fails stands alone.

    A failed run leaves marks and window as they were, and its submissions are handed over again with the same token.
    A conflict of the stored state is no bucket's fault and is raised.
    """
    try:
        return run(buckets)
    except StateConflict:
        raise
    except Exception as e:  # noqa: BLE001 - whatever one bucket's journal raises must not stop the others
        if len(buckets) == 1:
            return Outcome(errors={buckets[0]: str(e).splitlines()[0][:500] if str(e) else type(e).__name__})
    out = Outcome()
    middle = len(buckets) // 2
    for part in (buckets[:middle], buckets[middle:]):
        out.add(isolated(run, part))
    return out


def drain(run: Callable[[], Outcome], settings: Settings) -> list[Outcome]:
    """Runs in a chain while each is cut by the cap and moves on."""
    done = [run()]
    while should_continue(done[-1].capped, done[-1].progressed, len(done) - 1, settings.chain_limit):
        done.append(run())
    return done
