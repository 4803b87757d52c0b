"""Operator 6: near-duplicate vectors by randomised-rotation binary codes.

Each unit vector is turned by a random rotation; the signs after it are its binary code, kept with
the correction factor <code, vector> and the turned vector in steps of one byte, whose rounding error
is kept too. These are made and written once; they alone travel. The code gives an unbiased
estimate of the inner product with another vector (<code, other> / factor), and its confidence bound says
which pairs could reach the threshold. Of those the bytes decide what their error allows; the rest are
recomputed exactly, from the two vectors that are fetched for them alone.

Rows meet in bands of the same signs under further rotations: a band's width follows the number
of vectors and the number of bands follows from the recall wanted for a pair exactly at the threshold, so
the work grows about in proportion to the rows. Buckets above BLOCK rows are split into pairs of
blocks, so none is gathered in one task.
"""

from __future__ import annotations

import math
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import connected_components, parts, written
from tagflow.llm.vectors import finite, stacked

BLOCK = 8192
#: Rows for one task, and how many heavy buckets may be broadcast (two numbers each).
TASK_ROWS, BROADCAST_ROWS = 60_000, 50_000
#: Wanted chance that a pair exactly at the threshold shares a bucket; width of the confidence bound in standard errors.
RECALL, EPSILON = 0.97, 4.0


@lru_cache(256)
def rotation(size: int, seed: int) -> np.ndarray:
    """A random rotation: the orthogonal factor of a Gaussian matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def bands(rows: int, threshold: float) -> tuple[int, int]:
    """Bits of a band and the number of bands."""
    bits = min(62, max(4, round(math.log2(max(rows, 1) / 48 + 1))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - same))


class Coded:
    """Codes, factors and byte steps of turned unit vectors, as packed for the way (`pack`) or unpacked."""

    def __init__(self, levels: np.ndarray, factor: np.ndarray, scale: np.ndarray, slack: np.ndarray) -> None:
        self.levels, self.factor, self.scale, self.slack = levels, factor, scale, slack
        self.near = levels * scale[:, None].astype(float)

    @property
    def sign(self) -> np.ndarray:
        return np.where(self.levels > 0, 1.0, -1.0) / math.sqrt(self.levels.shape[1])

    @classmethod
    def of(cls, x: np.ndarray) -> Coded:
        size = x.shape[1]
        x = x / np.abs(x).max(1)[:, None]
        turned = x / np.sqrt((x * x).sum(1))[:, None] @ rotation(size, 0)
        scale = (np.abs(turned).max(1) / 127).astype(np.float32)
        levels = np.rint(turned / scale[:, None].astype(float)).astype(np.int8)
        slack = np.sqrt(((turned - levels * scale[:, None].astype(float)) ** 2).sum(1))
        out = cls(levels, np.zeros(0), scale, np.nextafter((slack * (1 + 1e-9) + 1e-12).astype(np.float32), np.float32(2)))
        out.factor = np.maximum((out.sign * turned).sum(1), 1e-6).astype(np.float32)
        return out

    def pack(self) -> list[bytes]:
        """One value a row: factor, scale, rounding error, steps."""
        head = np.stack((self.factor, self.scale, self.slack), 1).astype("<f4")
        return [h.tobytes() + v.tobytes() for h, v in zip(head, self.levels, strict=True)]

    @classmethod
    def unpack(cls, packed: pd.Series) -> Coded:
        raw = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
        head = np.ascontiguousarray(raw[:, :12]).view("<f4")
        return cls(np.ascontiguousarray(raw[:, 12:]).view(np.int8), head[:, 0], head[:, 1], head[:, 2])

    def keys(self, bits: int, count: int) -> np.ndarray:
        """Band keys: signs of the byte steps under rotations of their own, so that whoever holds these has the keys."""
        size = self.levels.shape[1]
        signs = np.concatenate([self.near @ rotation(size, 1 + k) > 0 for k in range(-(-bits * count // size))], 1)
        return signs[:, : bits * count].reshape(-1, count, bits).astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))


def coded(classes: DataFrame, size: int, bits: int, count: int) -> DataFrame:
    """vec_id, n, code (packed) and band keys of every vector; written once."""

    def work(batches):
        for batch in batches:
            if len(batch):
                c = Coded.of(stacked(batch["embedding"]))
                yield pd.DataFrame({"vec_id": batch["vec_id"], "n": batch["n"], "code": c.pack(), "keys": list(c.keys(bits, count))})

    return written(classes.mapInPandas(work, "vec_id long, n long, code binary, keys array<long>"))


def _judged(c: Coded, threshold: float, left: slice, right: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (one of `left`, a later one of `right`) that could reach the threshold, and whether the bytes prove that they do."""
    size = c.levels.shape[1]
    factor, slack = c.factor.astype(float), c.slack.astype(float)
    margin = EPSILON * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(size - 1, 1))
    high = (c.sign[left] @ c.near[right].T + slack[right][None, :]) / factor[left][:, None] + margin[left][:, None]
    i, j = np.nonzero(high >= threshold)
    i, j = i + left.start, j + right.start
    i, j = i[i < j], j[i < j]
    estimate = np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", c.near[i[k : k + (1 << 15)]], c.near[j[k : k + (1 << 15)]]) for k in range(0, len(i), 1 << 15))])
    error = slack[i] + slack[j] + slack[i] * slack[j] + 1e-9
    could = estimate + error >= threshold
    return i[could], j[could], (estimate - error >= threshold)[could]


def _local(frame: pd.DataFrame, bits: int, count: int, threshold: float) -> pd.DataFrame:
    """Of one bucket or pair of blocks: degrees and links to the smallest connected id, and pairs (vec_id, other) to be recomputed."""
    frame = frame.sort_values("vec_id", kind="stable")
    c = Coded.unpack(frame["code"])
    ids, n, side, band = frame["vec_id"].to_numpy(np.int64), frame["n"].to_numpy(np.int64), frame["side"].to_numpy(), int(frame["band"].iloc[0])
    keys, size = c.keys(bits, count), len(frame)
    degree, root = np.zeros(size, np.int64), np.arange(size)
    links, open_ = [], []
    for a in range(0, size, 2048):
        for b in range(a, size, 2048):
            i, j, sure = _judged(c, threshold, slice(a, min(a + 2048, size)), slice(b, min(b + 2048, size)))
            own = (keys[i] == keys[j]).argmax(1) == band  # the first band that they share
            if side.any():  # a pair of different blocks: links inside a block are found with the block itself
                own &= side[i] != side[j]
            links.append((i[own & sure], j[own & sure]))
            open_.append((i[own & ~sure], j[own & ~sure]))
            np.add.at(degree, links[-1][0], n[links[-1][1]])
            np.add.at(degree, links[-1][1], n[links[-1][0]])
    i, j = (np.concatenate(p) for p in zip(*links, strict=True))
    while len(i):
        before = root.copy()
        lowest = np.minimum(root[i], root[j])
        np.minimum.at(root, i, lowest)
        np.minimum.at(root, j, lowest)
        root = root[root]
        if (before == root).all():
            break
    used = (degree > 0) | (root != np.arange(size))
    i, j = (np.concatenate(p) for p in zip(*open_, strict=True))
    return pd.concat((pd.DataFrame({"vec_id": ids[used], "degree": degree[used], "root": ids[root[used]], "other": -1, "ask": False}), pd.DataFrame({"vec_id": ids[i], "degree": 0, "root": ids[i], "other": ids[j], "ask": True})))


FOUND = "vec_id long, degree long, root long, other long, ask boolean"


def _found(classes: DataFrame, size: int, rows: int, threshold: float) -> DataFrame:
    """vec_id, degree and a smaller linked id (root), by task, and pairs to be recomputed, of vectors of one length."""
    bits, count = bands(rows, threshold)
    marked = coded(classes, size, bits, count)
    each = marked.select("vec_id", "n", "code", F.posexplode("keys").alias("band", "key"))
    heavy = each.groupBy("band", "key").count().where(F.col("count") > BLOCK)
    heavy = written(heavy.select("band", "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")))
    n_heavy = heavy.count()
    if n_heavy:
        each = each.join(F.broadcast(heavy) if n_heavy <= BROADCAST_ROWS else heavy, ["band", "key"], "left")
    else:
        each = each.withColumn("blocks", F.lit(1))
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("vec_id"), blocks).cast("int")
    each = each.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    each = each.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).withColumn("side", F.col("own") != F.col("lo"))
    tasks = parts(rows * count, TASK_ROWS, 6)
    each = each.select("vec_id", "n", "code", "band", "key", "lo", "hi", "side", F.pmod(F.xxhash64("band", "key", "lo", "hi"), F.lit(tasks)).alias("task"))

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        columns = ["band", "key", "lo", "hi"]
        frame = frame.sort_values(columns, ignore_index=True)
        code = frame[columns].to_numpy(np.int64)
        head = np.flatnonzero(np.concatenate(([True], (code[1:] != code[:-1]).any(1))))
        out = [pd.DataFrame({"vec_id": np.zeros(0, np.int64), "degree": np.zeros(0, np.int64), "root": np.zeros(0, np.int64), "other": np.zeros(0, np.int64), "ask": np.zeros(0, bool)})]
        for i, j in zip(head, [*head[1:], len(frame)], strict=False):
            if j - i > 1:
                out.append(_local(frame.iloc[i:j], bits, count, threshold))
        return pd.concat(out).groupby(["vec_id", "root", "other", "ask"], as_index=False).sum()[["vec_id", "degree", "root", "other", "ask"]]

    return written(each.groupBy("task").applyInPandas(work, FOUND))


def _exact(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Degrees and roots of the pairs (vec_id, other) whose cosine, in double precision, reaches the threshold."""
    side = lambda k: classes.select(F.col("vec_id").alias(k), F.col("n").alias(f"n_{k}"), F.col("embedding").alias(f"x_{k}"))
    both = pairs.select(F.col("vec_id").alias("a"), F.col("other").alias("b")).join(side("a"), "a").join(side("b"), "b")
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    good = both.where(dot("x_a", "x_b") >= threshold * F.sqrt(dot("x_a", "x_a")) * F.sqrt(dot("x_b", "x_b")))
    good = good.select("a", "b", "n_a", "n_b")
    return good.select(F.col("b").alias("vec_id"), F.col("n_a").alias("degree"), F.col("a").alias("root")).unionByName(good.select(F.col("a").alias("vec_id"), F.col("n_b").alias("degree"), F.col("a").alias("root")))


def near_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of `vectors` (vec_id, embedding).

    Null, empty, zero and non-finite vectors link with nothing, others only with vectors of their
    length. Equal vectors are indexed once and counted as often as they stand there. A null
    vec_id has no component. An empty table gives no rows; extra columns are ignored. Pairs whose cosine the
    bytes leave open (within about 0.013 of the threshold in 64 dimensions) are joined with their vectors.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    fit = rows.where(finite(rows, "embedding")).where(F.exists("embedding", lambda x: x != 0)).where("vec_id IS NOT NULL")
    classes = written(fit.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("n")).select("vec_id", "n", "embedding"))
    lengths = classes.groupBy(F.size("embedding").alias("size")).count().where("count > 1").orderBy("size").collect()
    each = [_found(classes.where(F.size("embedding") == r["size"]), r["size"], r["count"], threshold) for r in lengths]
    judged = reduce(DataFrame.unionByName, each, vectors.sparkSession.createDataFrame([], FOUND))
    links = judged.where("NOT ask").select("vec_id", "degree", "root")
    found = links.unionByName(written(_exact(judged.where("ask"), classes, threshold)))
    degree = found.groupBy("vec_id").agg(F.sum("degree").alias("degree"))
    joined = connected_components(found.where("vec_id <> root").select(F.col("vec_id").alias("a"), F.col("root").alias("b")).distinct())
    named = (
        classes.join(degree, "vec_id", "left")
        .join(joined, classes["vec_id"] == joined["id"], "left")
        .select(F.col("embedding").alias("e"), (F.col("n") - 1 + F.coalesce("degree", F.lit(0))).alias("links"), F.coalesce("component_id", "vec_id").alias("root"))
    )
    all_ = rows.join(named, (rows["embedding"] == named["e"]) & rows["vec_id"].isNotNull(), "left")
    component = F.coalesce("root", "vec_id")
    return all_.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
