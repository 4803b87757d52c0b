"""Session helpers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ARCHIVE = "tagflow_package.zip"


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, through Spark's own file server."""
    sc = spark.sparkContext
    if ARCHIVE in sc._python_includes:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="package-")) / ARCHIVE
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
