"""Which run folders may go: mark and sweep from what state names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagflow.functions.columns import subtract


def run_of(path: Column, root: str) -> Column:
    """The run folder under `root` that holds a path; null for a path elsewhere."""
    base = f"{root.rstrip('/')}/"
    name = F.substring_index(F.substr(path, F.lit(len(base) + 1)), "/", 1)
    return F.when(path.startswith(base) & (name != ""), name)


def doomed(folders: DataFrame, references: DataFrame, root: str, now: Column, grace_s: int) -> DataFrame:
    """Folders (run, modified) that no reference (path) lies in and that are older than the grace, which a run in progress has.

    A folder without a time stays: its age is not known.
    """
    held = references.select(run_of(F.col("path"), root).alias("held")).where("held IS NOT NULL").distinct()
    old = folders.where(F.col("modified") < subtract(now, grace_s))
    return old.join(held, old["run"] == held["held"], "left_anti")
