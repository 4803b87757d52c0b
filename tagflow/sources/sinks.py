"""Sinks: manifest files with checksum before envelope, and versioned state documents."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagflow.operators.retention import doomed


class StateConflict(RuntimeError):
    """The state was changed by another writer, or is there already."""


class Files:
    """Small files of the driver on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")
        self.fs = self._path("").getFileSystem(self.conf)
        self.fs.mkdirs(self._path(""))

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self) -> list[str]:
        return [x.getPath().getName() for x in self.fs.listStatus(self._path(""))]

    def folders(self) -> list[tuple[str, int]]:
        """Names of the folders here, and when each was changed last (milliseconds)."""
        return [(x.getPath().getName(), x.getModificationTime()) for x in self.fs.listStatus(self._path("")) if x.isDirectory()]

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Put the whole text under a new name, or raise FileExistsError: it is written beside and renamed, so no part of it is ever seen."""
        draft = self._path(f".{name}.{uuid.uuid4()}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        plain = self.conf.getClass().getClassLoader().loadClass("org.apache.hadoop.fs.Options$Rename")
        options = self.jvm.java.lang.reflect.Array.newInstance(plain, 1)
        options[0] = rename.NONE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            context.rename(draft, self._path(name), options)
        except Py4JJavaError as e:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(e.java_exception):
                raise FileExistsError(name) from e
            raise


class StateStore:
    """One small JSON document for each name, written only over the version that was read.

    A version is a file of its own in a folder of any file system that Spark reaches; drafts that a
    crash left behind are never read.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.files = Files(spark, folder)

    def _versions(self, name: str) -> list[int]:
        parts = [x.rsplit(".", 2) for x in self.files.names() if not x.startswith(".")]
        return sorted(int(x[1]) for x in parts if len(x) == 3 and x[0] == name and x[2] == "json" and x[1].isdigit())

    def read(self, name: str) -> tuple[dict | None, int | None]:
        found = self._versions(name)
        return (json.loads(self.files.read(f"{name}.{found[-1]}.json")), found[-1]) if found else (None, None)

    def write(self, name: str, document: dict, version: int | None) -> int:
        """Create (`version` None) or replace; the exclusive name of the next version decides a race."""
        found = self._versions(name)
        if (found[-1] if found else None) != version:
            raise StateConflict(name)
        fresh = (version or 0) + 1
        try:
            self.files.write(f"{name}.{fresh}.json", json.dumps(document))
        except FileExistsError as e:
            raise StateConflict(name) from e
        return fresh

    def update(self, name: str, change: Callable[[dict | None], dict], tries: int = 5) -> int:
        """Read, change and write, and again where another writer came between, at most `tries` times."""
        for _ in range(tries):
            document, version = self.read(name)
            try:
                return self.write(name, change(document), version)
            except StateConflict:
                continue
        raise StateConflict(name)


def _texts(value: object) -> list[str]:
    """All texts of a document, however deep."""
    if isinstance(value, str):
        return [value]
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else []
    return [t for x in inner for t in _texts(x)]


def swept(spark: SparkSession, root: str, stores: list[tuple[StateStore, str]], now: datetime, grace_s: int, keep: tuple[str, ...] = ()) -> list[str]:
    """Delete the run folders under `root` that no current document of the stores names and that are older than the grace.

    `now` is in UTC. Documents are read after the folders are listed, so a folder that a run commits meanwhile is seen as named or is
    within the grace. One row a run folder reaches the driver. Folders in `keep` (state itself) stay.
    """
    files = Files(spark, root)
    listed = [(n, datetime.fromtimestamp(t / 1000, UTC).replace(tzinfo=None)) for n, t in files.folders() if n not in keep]
    named = [(t,) for store, name in stores for t in _texts(store.read(name)[0])]
    folders = spark.createDataFrame(listed, "run string, modified timestamp_ntz")
    references = spark.createDataFrame(named, "path string")
    gone = [r.run for r in doomed(folders, references, root, F.lit(now.isoformat(" ")).cast("timestamp_ntz"), grace_s).select("run").collect()]
    for name in gone:
        files.remove(name)
    return sorted(gone)


FORMAT = {"version": "2016-11-30", "fileFormat": "CSV", "fileSchema": "Bucket, Key, VersionId"}


def write_envelope(spark: SparkSession, folder: str, bucket: str, destination: str, created_ms: int, files: list[dict]) -> str:
    """Write the checksum of a bucket's envelope, then the envelope itself; returns the checksum.

    Who finds an envelope finds its checksum and all files that it names.
    """
    text = json.dumps({"sourceBucket": bucket, "destinationBucket": destination, "creationTimestamp": str(created_ms), **FORMAT, "files": files})
    checksum = hashlib.md5(text.encode()).hexdigest()
    out = Files(spark, folder)
    out.write("manifest.checksum", checksum)
    out.write("manifest.json", text)
    return checksum


def write_manifests(rows: DataFrame, path: str, file_rows: int) -> dict[str, dict]:
    """Write the rows (bucket, row) of all buckets in one job; returns an envelope for each bucket.

    Rows are dealt by range, so a large bucket is spread over tasks, and no file has more than
    `file_rows` rows. What comes back to the driver is one row for each file.
    """
    spark: SparkSession = rows.sparkSession
    rows.repartitionByRange("bucket", "row").sortWithinPartitions("bucket", "row").write.partitionBy("bucket").option("maxRecordsPerFile", file_rows).text(path)
    written = spark.read.schema("value string, bucket string").text(path, wholetext=True) if _any(spark, path) else None
    if written is None:
        return {}
    lines = F.size(F.split(F.regexp_replace("value", "\n$", ""), "\n"))
    files = written.select("bucket", F.col("_metadata.file_path").alias("key"), F.octet_length("value").alias("size"), F.md5("value").alias("MD5checksum"), lines.alias("rows")).orderBy("bucket", "key").collect()
    out: dict[str, dict] = {}
    for r in files:
        entry = out.setdefault(r.bucket, {"sourceBucket": r.bucket, **FORMAT, "object_count": 0, "files": []})
        entry["files"].append({"key": r.key, "size": r.size, "MD5checksum": r.MD5checksum})
        entry["object_count"] += r.rows
    return out


def _any(spark: SparkSession, path: str) -> bool:
    """A bucket's folder is there (an empty result writes none)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/bucket=*")
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p))


def publish(rows: DataFrame, path: str, kind: str) -> None:
    """Append metric, alert or log rows as JSON lines, in a folder for each kind."""
    rows.write.mode("append").json(f"{path}/{kind}")


def publish_parts(rows: DataFrame, path: str, kind: str, size: int = 1000) -> None:
    """The same in files of at most `size` rows, as sinks take that have such a limit."""
    rows.write.mode("append").option("maxRecordsPerFile", size).json(f"{path}/{kind}")
