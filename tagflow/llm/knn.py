"""Operator 8: exact top-k inner products by a Voronoi join.

Pivots (k-means on a bounded sample) cut data and queries into cells. Every query is first solved
within its own cell, which gives a real k-th best score as its lower bound. The queries of
neighbouring cells form groups of bounded size; from summaries of the cells (radius of the queries,
their smallest lower bound, their largest product with every pivot) each group gets an upper bound
of what a data row can score with any of its queries, and a row is sent to those groups alone that it
may matter to. Groups are solved locally, in blocks of bounded size, and the parts are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagflow.llm.common import parts, written
from tagflow.llm.vectors import finite, stacked, lengths

#: Cells at most, and vectors of the sample that the pivots are fitted on.
PIVOTS, SAMPLE = 64, 8192
#: Queries of a group and data rows of a block, which meet in one task.
ASKS, BLOCK = 4096, 65536
#: Scores that a task holds at once.
SCORES = 1 << 22
SCALE = 64


def k_means(x: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """At most `count` centres of the rows of `x` (their order decides the first ones)."""
    centre = np.unique(x[:count], axis=0)
    for _ in range(rounds):
        cell = ((centre * centre).sum(1)[None, :] - 2 * x @ centre.T).argmin(1)
        size = np.bincount(cell, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, cell, x)
        centre = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centre)
    return centre


def pivots(data: DataFrame, rows: int) -> np.ndarray:
    """Centres of a sample of at most SAMPLE distinct vectors, taken by a hash; about a quarter of the root of `rows` of them."""
    count = max(1, min(PIVOTS, math.isqrt(rows) // 4))
    share = 1 << 20 if rows <= SAMPLE else max(1, int((1 << 20) * 0.9 * SAMPLE / rows))
    drawn = data.where("r = 1").select("vector", F.xxhash64("vector").alias("h")).where(F.pmod("h", F.lit(1 << 20)) < share)
    picked = drawn.limit(SAMPLE).toPandas().sort_values("h")
    return k_means(stacked(picked["vector"]), count)


def assigned(data: DataFrame, centre: np.ndarray) -> DataFrame:
    """Adds the nearest pivot and the distance to it."""
    schema = ", ".join(f"{name} {kind}" for name, kind in [*data.dtypes, ("cell", "int"), ("far", "double")])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = stacked(batch["vector"])
                cell = ((centre * centre).sum(1)[None, :] - 2 * x @ centre.T).argmin(1)
                yield batch.assign(cell=cell, far=np.sqrt(((x - centre[cell]) ** 2).sum(1)))

    return data.mapInPandas(work, schema)


def grouped(asks: dict[int, int], centre: np.ndarray) -> list[list[int]]:
    """Cells with queries in groups of at most ASKS queries, near cells together (a larger cell is alone)."""
    left, out, room = set(asks), [], 0
    at = min(left, default=None)
    while left:
        left.remove(at)
        if asks[at] > room:
            out.append([])
            room = ASKS
        out[-1].append(at)
        room -= asks[at]
        if left:
            rest = np.array(sorted(left))
            at = int(rest[((centre[rest] - centre[at]) ** 2).sum(1).argmin()])
    return out


def highest(asks: DataFrame, centre: np.ndarray) -> np.ndarray:
    """Largest product of a query of each cell with every pivot (cells x pivots, at most PIVOTS squared)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                product = pd.DataFrame(stacked(batch["vector"]) @ centre.T)
                best = product.groupby(batch["cell"].to_numpy()).max()
                yield pd.DataFrame({"cell": np.repeat(best.index.to_numpy(), len(centre)), "pivot": np.tile(np.arange(len(centre)), len(best)), "high": best.to_numpy().ravel()})

    found = asks.select("vector", "cell").mapInPandas(work, "cell int, pivot int, high double").groupBy("cell", "pivot").agg(F.max("high").alias("high")).toPandas()
    out = np.full((len(centre), len(centre)), -np.inf)
    out[found["cell"], found["pivot"]] = found["high"]
    return out


def replicated(data: DataFrame, centre: np.ndarray, groups: list[list[int]], reach: np.ndarray, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """Every data row once for each group with a query that it may score enough with.

    For a query q of cell i and a row x of cell j: q.x = c_i.x + (q - c_i).x, and also
    q.x = q.c_j + c_i.(x - c_j) + (q - c_i).(x - c_j); the smaller bound of the two holds.
    """
    own = np.array([c for g in groups for c in g])
    first = np.cumsum([0, *(len(g) for g in groups)])[:-1]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x, cell = stacked(batch["vector"]), batch["cell"].to_numpy(np.int64)
            away = x - centre[cell]
            norm, far = np.sqrt((x * x).sum(1)), np.sqrt((away * away).sum(1))
            whole = x @ centre[own].T + norm[:, None] * reach[own][None, :]
            inner = high[own][:, cell].T + away @ centre[own].T + far[:, None] * reach[own][None, :]
            most = np.minimum(whole, inner)
            needed = np.logical_or.reduceat(most + 1e-6 + 1e-9 * np.abs(most) >= low[own][None, :], first, axis=1)
            for g in range(len(first)):
                if needed[:, g].any():
                    yield batch.loc[needed[:, g], ["vec_id", "vector", "n"]].assign(grp=g)

    return data.mapInPandas(work, "vec_id long, vector array<double>, n int, grp int")


def _of_group(values: list[int]) -> Column:
    """What a bounded list holds for the group of a row."""
    return F.element_at(F.array(*(F.lit(int(v)) for v in values)), F.col("grp") + 1)


#: Products of norms below this give sums that doubles hold exactly.
EXACT = 2.0**53


def exact(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs (i, j); one that is no long is an error."""
    a, b = [[int(v) for v in row] for row in q], {k: [int(v) for v in x[k]] for k in set(j.tolist())}
    out = [sum(map(int.__mul__, a[m], b[n])) for m, n in zip(i.tolist(), j.tolist(), strict=True)]
    if any(not -(1 << 63) < v < 1 << 63 for v in out):
        raise OverflowError("a score is beyond a long")
    return np.array(out, np.int64)


def solved(asks: DataFrame, data: DataFrame, shares: list[int], blocks: list[int], k: int) -> DataFrame:
    """ask, vec_id, n, score: of each block of the query's group the k best rows that reach the query's bound `low`.

    `asks` has ask, vec_id, vector, low, grp; `data` vec_id, vector, n, grp. A group's queries are cut
    in `shares` and its data in `blocks`; every share meets every block in one task.
    """
    a = asks.select("ask", "vec_id", "vector", "low", "grp", F.pmod(F.xxhash64("ask"), _of_group(shares)).cast("int").alias("share"), F.explode(F.sequence(F.lit(0), _of_group(blocks) - 1)).alias("block"))
    d = data.select("vec_id", "vector", "n", "grp", F.explode(F.sequence(F.lit(0), _of_group(shares) - 1)).alias("share"), F.pmod(F.xxhash64("vec_id", "vector"), _of_group(blocks)).cast("int").alias("block"))

    def work(ask: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c: np.zeros(0, np.int64) for c in ("ask", "vec_id", "n", "score")})]
        if len(ask) and len(block):
            block = block.sort_values("vec_id", kind="stable")
            ids, many, x = block["vec_id"].to_numpy(np.int64), block["n"].to_numpy(np.int64), stacked(block["vector"])
            step = max(1, SCORES // len(ids))
            for s in range(0, len(ask), step):
                part = ask.iloc[s : s + step]
                q = stacked(part["vector"])
                score = q @ x.T
                # what a score may be off by, nothing where all sums are integers that doubles hold
                norm = np.sqrt((q * q).sum(1)) * np.sqrt((x * x).sum(1).max())
                off = np.where(norm < EXACT, 0.0, norm * (q.shape[1] + 2) * 2.0**-52)
                score[part["vec_id"].to_numpy(np.int64)[:, None] == ids[None, :]] = -np.inf
                take = min(k, len(ids))
                cut = np.maximum(-np.partition(-score, take - 1, axis=1)[:, take - 1], part["low"].to_numpy(float))
                i, j = np.nonzero((score >= (cut - 4 * off)[:, None]) & (score > -np.inf))
                value = exact(q, x, i, j) if off.any() else score[i, j].astype(np.int64)
                order = np.lexsort((j, -value, i))
                i, j, value = i[order], j[order], value[order]
                keep = np.arange(len(i)) - np.searchsorted(i, i) < k
                i, j, value = i[keep], j[keep], value[keep]
                out.append(pd.DataFrame({"ask": part["ask"].to_numpy(np.int64)[i], "vec_id": ids[j], "n": many[j], "score": value}))
        return pd.concat(out)

    keys = ("grp", "share", "block")
    return a.groupBy(*keys).cogroup(d.groupBy(*keys)).applyInPandas(work, "ask long, vec_id long, n long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query, rows that stand there n times counted n times."""
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    best = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id", "copy")
    return each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_scores(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of every query.

    Queries are the rows whose vec_id is divisible by `every`; candidates are all rows with another
    vec_id and a vector of the same length (there is no product of others). Components are floor(64 x); scores are exact, and
    one beyond a long is an error. Ties go to the smaller vec_id. Null ids, null, empty and non-finite vectors take no part.
    Repeated rows are candidates of their own; a query that is there twice is answered twice. An empty table gives no
    rows; extra columns are ignored. Of equal vectors only the k + 1 smallest ids are candidates: the
    others cannot be among the k best of any query.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    fit = rows.where(finite(rows, "embedding")).where("vec_id IS NOT NULL")
    out = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for size in lengths(fit, "embedding"):
        out = out.unionByName(_of_length(fit.where(F.size("embedding") == size), k, every))
    return out


def _whole(x: Column) -> Column:
    """The floor as a double; from 2^52 on every double is whole."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


def _of_length(fit: DataFrame, k: int, every: int) -> DataFrame:
    """`top_scores` of vectors of one length."""
    spark = fit.sparkSession
    whole = fit.select("vec_id", F.transform("embedding", lambda x: _whole(x * SCALE)).alias("vector"))
    each = written(whole.groupBy("vec_id", "vector").agg(F.count("*").alias("m")))
    same = Window.partitionBy("vector").orderBy("vec_id")
    data = written(each.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k + 1).select("vec_id", "vector", F.least("m", F.lit(k)).cast("int").alias("n"), "r"))
    count = data.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centre = pivots(data, count)
    placed = written(assigned(data.drop("r"), centre))
    asked = each.where(F.col("vec_id") % every == 0).withColumn("ask", F.monotonically_increasing_id())
    asks = written(assigned(asked, centre))

    held = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}  # at most PIVOTS rows
    wanted = {r["cell"]: r["count"] for r in asks.groupBy("cell").count().collect()}
    if not wanted:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    home = [parts(wanted.get(c, 0), ASKS, 1) for c in range(len(centre))], [parts(held.get(c, 0), BLOCK, 1) for c in range(len(centre))]
    first = solved(asks.select("ask", "vec_id", "vector", F.lit(-math.inf).alias("low"), F.col("cell").alias("grp")), placed.where(F.col("cell").isin(list(wanted))).select("vec_id", "vector", "n", F.col("cell").alias("grp")), *home, k)
    bound = ranked(first, k).where(F.col("rank") == k).select(F.col("ask").alias("for"), F.col("score").cast("double").alias("low"))
    bounded = written(asks.join(bound, asks["ask"] == bound["for"], "left").select("ask", "vec_id", "vector", "m", "cell", "far", F.coalesce("low", F.lit(-math.inf)).alias("low")))

    reach, low = np.zeros(len(centre)), np.full(len(centre), np.inf)
    for r in bounded.groupBy("cell").agg(F.max("far").alias("reach"), F.min("low").alias("low")).collect():  # at most PIVOTS rows
        reach[r["cell"]], low[r["cell"]] = r["reach"] * (1 + 1e-9) + 1e-9, r["low"]
    groups = grouped(wanted, centre)
    shares = [parts(sum(wanted[c] for c in g), ASKS, 1) for g in groups]
    sent = written(replicated(placed, centre, groups, reach, low, highest(bounded, centre)))
    sizes = {r["grp"]: r["count"] for r in sent.groupBy("grp").count().collect()}  # one row a group
    blocks = [parts(sizes.get(g, 0), BLOCK, 1) for g in range(len(groups))]
    of_cell = F.create_map(*(F.lit(x) for g, cells in enumerate(groups) for c in cells for x in (c, g)))
    found = solved(bounded.withColumn("grp", of_cell[F.col("cell")]), sent, shares, blocks, k)
    best = ranked(found, k).select("ask", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("found"), "score")
    named = bounded.select("ask", F.col("vec_id").alias("query_id"), F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("copy"))
    return best.join(named, "ask").select("query_id", "rank", F.col("found").alias("vec_id"), "score")
