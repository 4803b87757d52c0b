"""Reading vectors out of Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite(df: DataFrame, vector: str) -> F.Column:
    """True where a vector is there, not empty, and all components are finite numbers."""
    ok = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & ok, F.lit(False))


def stacked(column: pd.Series) -> np.ndarray:
    """Equal-length vectors of a batch as a matrix of doubles."""
    return np.array([np.asarray(x, np.float64) for x in column])


def lengths(df: DataFrame, vector: str) -> list[int]:
    """The lengths that vectors have (one number each reaches the driver)."""
    return sorted(r["n"] for r in df.select(F.size(vector).alias("n")).distinct().collect())
