"""Configuration: the monitored buckets (all or nothing) and the settings of a run."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

MAX_BUCKETS = 1000
# Forms of a bucket's name, of an address that is none, and of a region.
NAME = re.compile(r"[a-z0-9][a-z0-9.\-]{1,61}[a-z0-9]")
ADDRESS = re.compile(r"\d{1,3}(\.\d{1,3}){3}")
REGION = re.compile(r"[a-z]{2,4}-([a-z]+-)+\d{1,2}")
FOREIGN = ("tag_filter", "destination")


class ConfigError(ValueError):
    """A configuration that cannot be used; the message names the entry."""


def _wrong(entry: object) -> str | None:
    if not isinstance(entry, Mapping):
        return "is not an object"
    held = [k for k in FOREIGN if k in entry]
    if held:
        return f"has {held[0]}, which the bucket's own rules define"
    name, region = entry.get("name"), entry.get("region")
    if not isinstance(name, str) or not NAME.fullmatch(name) or ".." in name or ADDRESS.fullmatch(name):
        return f"has no valid name: {name!r}"
    if not isinstance(region, str) or not REGION.fullmatch(region):
        return f"has no valid region: {region!r}"
    return None


def buckets(spark: SparkSession, document: object) -> DataFrame:
    """The buckets of a configuration document as rows (bucket, region); at most MAX_BUCKETS."""
    entries = document.get("buckets") if isinstance(document, Mapping) else None
    if not isinstance(entries, list) or not 0 < len(entries) <= MAX_BUCKETS:
        raise ConfigError(f"buckets must be a list of 1 to {MAX_BUCKETS} entries")
    seen = set()
    for k, entry in enumerate(entries):
        reason = _wrong(entry)
        if reason is None and (entry["name"], entry["region"]) in seen:
            reason = f"repeats {entry['name']!r}"
        if reason:
            raise ConfigError(f"bucket {k} {reason}")
        seen.add((entry["name"], entry["region"]))
    return spark.createDataFrame([(e["name"], e["region"]) for e in entries], "bucket string, region string")


@dataclass(frozen=True)
class Settings:
    """Settings of a run; an absent or unusable value of the environment gives the default."""

    lookback_s: int = 7200
    row_cap: int = 500_000
    chain_limit: int = 20
    failure_threshold: int = 3
    manifest_file_rows: int = 1_000_000
    check_batch: int = 2000
    tracking_ttl_s: int = 7 * 86400

    @classmethod
    def from_env(cls, env: Mapping[str, str]) -> Settings:
        """Read TAGFLOW_<NAME>; whole numbers only, negative ones are unusable."""
        named = {f.name: env.get(f"TAGFLOW_{f.name.upper()}", "").strip() for f in fields(cls)}
        return cls(**{k: int(v) for k, v in named.items() if re.fullmatch(r"[0-9]+", v) and (int(v) or k in ("lookback_s", "chain_limit", "tracking_ttl_s"))})


def should_continue(capped: bool, progressed: bool, depth: int, limit: int) -> bool:
    """Another run follows at once: this one was cut by its cap, moved on, and the chain has room."""
    return capped and progressed and max(depth, 0) < limit


# Memory sizes in MiB that a row cap is checked for, and rows that fit in each 1024 of them.
MEMORY_MB = (1024, 2048, 3072, 4096, 6144, 8192, 10240)
ROWS_PER_GB = 250_000


def row_ceiling(memory_mb: int) -> int:
    """Most rows of a run in the supported size nearest to `memory_mb` (of two as near, the smaller)."""
    nearest = min(MEMORY_MB, key=lambda size: (abs(size - memory_mb), size))
    return nearest // 1024 * ROWS_PER_GB


def check_row_cap(cap: int, memory_mb: int) -> None:
    """A cap above the ceiling of the memory is a configuration error."""
    if cap > row_ceiling(memory_mb):
        raise ConfigError(f"a row cap of {cap} is above the {row_ceiling(memory_mb)} rows that {memory_mb} MiB hold")


def interval_text(minutes: int) -> str:
    """Minutes as whole hours where they are, else as minutes."""
    return f"{minutes // 60}h" if minutes % 60 == 0 else f"{minutes}m"
