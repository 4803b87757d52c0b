"""Operator 5: language-model scores by context-tree weighting.

The model predicts each byte bit by bit. Every bit has a tree of contexts over the bytes before
it (up to DEPTH); each node holds a Krichevsky-Trofimov estimate, and the weighting of the tree
mixes the estimates of all depths. Counts come from training documents alone and are then
fixed, so a text's score is a sum over its (context, byte) pairs. Where training never saw a
context, the mix ends at the deepest node that it saw.

Documents are dealt into groups of bounded size. Each group sends its distinct tokens and
(context, byte) codes with training counts to buckets, which add them up in two steps (some
groups each, then all), so that what meets in one task are distinct codes, not one copy from each
group. A bucket works out the subtrees it holds whole, and every group gets the answers to what it
asked for. Only the nodes of depth zero and one (at most 256 * 255, whatever the input) pass
through the driver.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import checkpointed, id_long, id_text, parts, runs, text_bytes

DEPTH = 5
GROUP_BYTES, BUCKET_BYTES = 12 << 20, 24 << 20
#: Groups whose counts are added up together before all of them are.
MERGED_GROUPS = 64
HELD_OUT = 10
TOKENS, CODES = 0, 1


def is_held_out(doc_id: F.Column) -> F.Column:
    """crc32 of the id as text, modulo 10, is zero (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 0


def _codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Context and byte of every byte as one integer (DEPTH bytes before it, zero before the start), and text sizes."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(bytes(DEPTH) + bytes(DEPTH).join(texts), np.uint8).astype(np.uint64)
    code = data[DEPTH:].copy()
    for d in range(1, DEPTH + 1):
        code |= data[DEPTH - d : len(data) - d] << np.uint64(8 * d)
    own = np.zeros(len(code), bool)
    begin = np.cumsum(size + DEPTH) - (size + DEPTH)
    edge = np.zeros(len(code) + 1, np.int32)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + size, -1)
    own = np.cumsum(edge[:-1]) > 0
    return code[own], size


def _slices(texts: list[bytes], most: int = 2 << 20) -> list[tuple[int, int]]:
    out, begin = [], 0
    while begin < len(texts):
        stop, size = begin, 0
        while stop < len(texts) and (stop == begin or size + len(texts[stop]) <= most):
            size += len(texts[stop])
            stop += 1
        out.append((begin, stop))
        begin = stop
    return out


def _counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j in _slices(texts):
        code = np.sort(_codes(texts[i:j])[0])
        head = runs(code)
        keys.append(code[head])
        counts.append(np.diff(np.concatenate((head, [len(code)]))))
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)


def _bucket_of(code: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a code by its two nearest context bytes: a subtree of depth two stays whole."""
    near = (code >> np.uint64(8)) & np.uint64(0xFFFF)
    return (((near * np.uint64(2654435761)) >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64)


def _packed(x: np.ndarray) -> bytes:
    """An array, compressed with bytes of one significance together."""
    return zlib.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes(), 1)


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _pack_codes(code: np.ndarray) -> bytes:
    """Sorted codes as differences."""
    return _packed(np.diff(code, prepend=np.uint64(0)))


def _unpack_codes(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw, np.uint64), dtype=np.uint64)


def _pack_words(words: list[bytes]) -> bytes:
    return zlib.compress(b"\n".join(words), 1)


def _unpack_words(raw: bytes) -> list[bytes]:
    return zlib.decompress(raw).split(b"\n")


def _raw(frame: pd.DataFrame) -> list[bytes]:
    return [x.encode() if isinstance(x, str) else b"" for x in frame["text"]]


ASKED = "kind int, bucket long, salt long, grp long, item binary, n binary"


def asked(grouped: DataFrame, buckets: int, salts: int) -> DataFrame:
    """Distinct tokens and codes of every group with training counts, packed by bucket."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["grp"].iloc[0])
        texts, train = _raw(frame), ~frame["held"].to_numpy(bool)
        learned, seen = Counter(), set()
        for x, t in zip(texts, train.tolist(), strict=True):
            words = x.lower().split()
            learned.update(words) if t else seen.update(words)
        rows: dict[int, list[bytes]] = {}
        for word in sorted(learned.keys() | seen):
            rows.setdefault(zlib.crc32(word) % buckets, []).append(word)
        out = [(TOKENS, b, _pack_words(w), _packed(np.array([learned[x] for x in w], np.int64))) for b, w in rows.items()]
        known, count = _counted([x for x, t in zip(texts, train.tolist(), strict=True) if t])
        other, _ = _counted([x for x, t in zip(texts, train.tolist(), strict=True) if not t])
        other = np.setdiff1d(other, known)
        code, count = np.concatenate((known, other)), np.concatenate((count, np.zeros(len(other), np.int64)))
        bucket = _bucket_of(code, buckets)
        order = np.lexsort((code, bucket))
        head = runs(bucket[order])
        for i, j in zip(head, [*head[1:], len(order)], strict=False):
            o = order[i:j]
            out.append((CODES, int(bucket[o[0]]), _pack_codes(code[o]), _packed(count[o])))
        return pd.DataFrame([(k, b, group % salts, group, item, n) for k, b, item, n in out], columns=["kind", "bucket", "salt", "grp", "item", "n"])

    return grouped.groupBy("grp").applyInPandas(work, ASKED)


def _added_words(frame: pd.DataFrame) -> dict[bytes, int]:
    total: dict[bytes, int] = {}
    for item, n in zip(frame["item"], frame["n"], strict=True):
        for k, c in zip(_unpack_words(item), _unpacked(n, np.int64).tolist(), strict=True):
            total[k] = total.get(k, 0) + c
    return total


def _added_codes(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and their counts, added up piece by piece."""
    code, count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    for k, (item, n) in enumerate(zip(frame["item"], frame["n"], strict=True)):
        held.append((_unpack_codes(item), _unpacked(n, np.int64)))
        waiting += len(held[-1][0])
        if k + 1 == len(frame) or waiting > max(1 << 20, len(code)):
            every, weight = np.concatenate([code, *(h[0] for h in held)]), np.concatenate([count, *(h[1] for h in held)])
            code, at = np.unique(every, return_inverse=True)
            count = np.bincount(at, weight, len(code)).astype(np.int64)
            held, waiting = [], 0
    return code, count


def merged(rows: DataFrame) -> DataFrame:
    """The rows of each bucket and salt as one."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        kind, bucket, salt = (int(frame[c].iloc[0]) for c in ("kind", "bucket", "salt"))
        if kind == TOKENS:
            total = _added_words(frame)
            words = sorted(total)
            item, n = _pack_words(words), _packed(np.array([total[w] for w in words], np.int64))
        else:
            code, count = _added_codes(frame)
            item, n = _pack_codes(code), _packed(count)
        return pd.DataFrame([(kind, bucket, salt, item, n)], columns=["kind", "bucket", "salt", "item", "n"])

    return rows.groupBy("kind", "bucket", "salt").applyInPandas(work, "kind int, bucket long, salt long, item binary, n binary")


_LN2 = math.log(2)
_lgamma = np.frompyfunc(math.lgamma, 1, 1)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""

    def lg(x: np.ndarray) -> np.ndarray:
        kinds, at = np.unique(x, return_inverse=True)
        return _lgamma(kinds).astype(float)[at]

    return lg(n0 + 0.5) + lg(n1 + 0.5) - 2 * math.lgamma(0.5) - lg(n0 + n1 + 1.0)


def weigh(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability of a node and the share of its own estimate in it."""
    high = np.maximum(own, below)
    total = high + np.log(np.exp(own - high) + np.exp(below - high)) - _LN2
    return total, np.exp(own - _LN2 - total)


def _sums(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    kinds, at = np.unique(key, return_inverse=True)
    return kinds, at, [np.bincount(at, v, len(kinds)) for v in values]


def subtree(code: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """The nodes of a bucket from DEPTH to two, mixed.

    For every (code, bit): the bit, the probability of a one by the node of depth two and all
    below it, whether training saw that node, and its parent's key. Then the parents themselves.
    """
    byte = (code & np.uint64(255)).astype(np.int64)
    bit = np.arange(8)
    node = (1 << bit) | (byte[:, None] >> (8 - bit))
    one = ((byte[:, None] >> (7 - bit)) & 1).ravel()
    weight = np.repeat(count, 8)
    key = (((code >> np.uint64(8)).astype(np.int64)[:, None] << 8) | node).ravel()
    key, path, (n0, n1) = _sums(key, weight * (1 - one), weight * one)
    weighted = log_kt(n0, n1)
    mix = ((n1 + 0.5) / (n0 + n1 + 1))[path]
    seen = (n0 + n1 > 0)[path]
    for depth in range(DEPTH - 1, 1, -1):
        key, up, (n0, n1, below) = _sums(key & ((1 << (8 * depth + 8)) - 1), n0, n1, weighted)
        weighted, share = weigh(log_kt(n0, n1), below)
        path = up[path]
        own = ((n1 + 0.5) / (n0 + n1 + 1))[path]
        mix = np.where(seen, share[path] * own + (1 - share[path]) * mix, own)
        seen = (n0 + n1 > 0)[path]
    top, up, (n0, n1, below) = _sums(key & 0xFFFF, n0, n1, weighted)
    return one, mix, seen, top[up[path]], {"node": top, "n0": n0, "n1": n1, "under": below}


def top_nodes(rows: DataFrame) -> pd.DataFrame:
    """Counts and weighted children of the nodes of depth one: at most 256 * 255 rows."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        code, count = _added_codes(frame)
        return pd.DataFrame(subtree(code[count > 0], count[count > 0])[4])

    part = rows.where(f"kind = {CODES}").groupBy("bucket").applyInPandas(work, "node long, n0 double, n1 double, under double")
    return part.groupBy("node").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "under"))).orderBy("node").limit(256 * 256).toPandas()


def mixture(top: pd.DataFrame) -> dict[str, np.ndarray]:
    """Estimates and shares of depths zero and one, for every node of depth one."""
    share1, share0 = np.full(1 << 16, 0.5), np.full(256, 0.5)
    kt1, kt0, seen1 = np.full(1 << 16, 0.5), np.full(256, 0.5), np.zeros(1 << 16, bool)
    at, n0, n1 = top["node"].to_numpy(np.int64), top["n0"].to_numpy(float), top["n1"].to_numpy(float)
    if len(at):
        p1, share1[at] = weigh(log_kt(n0, n1), top["under"].to_numpy(float))
        kt1[at], seen1[at] = (n1 + 0.5) / (n0 + n1 + 1), n0 + n1 > 0
        root, _, (r0, r1, under) = _sums(at & 255, n0, n1, p1)
        _, share0[root] = weigh(log_kt(r0, r1), under)
        kt0[root] = (r1 + 0.5) / (r0 + r1 + 1)
    node = np.arange(1 << 16) & 255
    return {"kt1": kt1, "share1": share1, "seen1": seen1, "kt0": kt0[node], "share0": share0[node]}


def probabilities(code: np.ndarray, count: np.ndarray, low: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For every (code, bit): the bit, and the probability of a one by the mix of all depths."""
    one, mix, seen, node, _ = subtree(code, count)
    first = np.where(seen, low["share1"][node] * low["kt1"][node] + (1 - low["share1"][node]) * mix, low["kt1"][node])
    return one, np.where(low["seen1"][node], low["share0"][node] * low["kt0"][node] + (1 - low["share0"][node]) * first, low["kt0"][node])


def answered(rows: DataFrame, sums: DataFrame, low: dict[str, np.ndarray]) -> DataFrame:
    """For every group: its tokens with their corpus counts, and its codes with log10 probabilities.

    A bucket answers each salt's row of `sums` with values for what that row asks, so what is sent out
    is as much as was asked, whatever the number of salts.
    """

    def model(frame: pd.DataFrame) -> pd.DataFrame:
        if frame["kind"].iloc[0] == TOKENS:
            total = _added_words(frame)
            value = [_packed(np.array([total[w] for w in _unpack_words(x)], np.int64)) for x in frame["item"]]
        else:
            code, count = _added_codes(frame)
            one, high = probabilities(code, count, low)
            score = np.log10(np.where(one == 1, high, 1 - high)).reshape(-1, 8).sum(1).astype(np.float32)
            value = [_packed(score[np.searchsorted(code, _unpack_codes(x))]) for x in frame["item"]]
        return frame[["kind", "bucket", "salt", "item"]].assign(value=value)

    def work(frame: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(frame) and frame["kind"].iloc[0] == TOKENS:
            total = dict(zip(_unpack_words(found["item"].iloc[0]), _unpacked(found["value"].iloc[0], np.int64).tolist(), strict=True))
            out = [_packed(np.array([total[w] for w in _unpack_words(x)], np.int64)) for x in frame["item"]]
        elif len(frame):
            code, score = _unpack_codes(found["item"].iloc[0]), _unpacked(found["value"].iloc[0], np.float32)
            out = [_packed(score[np.searchsorted(code, _unpack_codes(x))]) for x in frame["item"]]
        return pd.DataFrame({"kind": frame["kind"], "grp": frame["grp"], "item": frame["item"], "value": out})

    table = sums.groupBy("kind", "bucket").applyInPandas(model, "kind int, bucket long, salt long, item binary, value binary")
    keys = ("kind", "bucket", "salt")
    return rows.groupBy(*keys).cogroup(table.groupBy(*keys)).applyInPandas(work, "kind int, grp long, item binary, value binary")


def _found(own: np.ndarray, code: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Values of the codes `own` (all in the sorted `code`), looked up in sorted order so that memory is read in sequence."""
    order = np.argsort(own)
    out = np.empty(len(own))
    if len(own):
        out[order] = value[np.searchsorted(code, own[order])]
    return out


SCORES = "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame) -> DataFrame:
    """Scores of every row of `docs`: log10 probabilities by the weighted trees and by smoothed token counts.

    Null texts are empty: one token (the end) and a score of zero. Equal rows are scored (and
    learned from) once each. With no training rows all estimates are one half. A null doc_id stays null and counts as
    the empty text in the choice of held-out rows. Extra columns are ignored, an empty table gives no rows. A very
    long text is in one group by itself and costs memory in proportion to its bytes.
    """
    total = text_bytes(docs)
    groups, buckets = parts(total, GROUP_BYTES, 6), parts(total, BUCKET_BYTES, 6)
    salts = parts(groups, MERGED_GROUPS)
    grouped = id_text(docs).select("doc_id", "text", is_held_out(F.col("doc_id")).alias("held"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("long").alias("grp"))
    rows = checkpointed(asked(grouped, buckets, salts))
    sums = checkpointed(merged(rows))
    low = mixture(top_nodes(sums))
    tokens = sums.where(f"kind = {TOKENS}").groupBy("bucket").applyInPandas(_token_totals, "n long, v long").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    ends = docs.select(is_held_out(F.col("doc_id")).alias("held")).where(~F.col("held")).count()
    n_all, distinct = int(tokens["n"] or 0) + ends, int(tokens["v"] or 0) + (ends > 0)
    scale = math.log10(n_all + 0.1 * (distinct + 1))

    def work(frame: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(frame):
            return pd.DataFrame(columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        texts = _raw(frame)
        count: dict[bytes, float] = {}
        codes, values = [np.zeros(0, np.uint64)], [np.zeros(0, np.float32)]
        for kind, item, value in zip(found["kind"], found["item"], found["value"], strict=True):
            if kind == TOKENS:
                count.update(zip(_unpack_words(item), _unpacked(value, np.int64).tolist(), strict=True))
            else:
                codes.append(_unpack_codes(item))
                values.append(_unpacked(value, np.float32))
        code, value = np.concatenate(codes), np.concatenate(values)
        order = np.argsort(code)
        code, value = code[order], value[order]
        n_tokens, n_known, plain, model = [], [], [], []
        for i, j in _slices(texts):
            words = [x.lower().split() for x in texts[i:j]]
            size = np.array([len(x) for x in words])
            c = np.array([count[w] for x in words for w in x], float)
            end = np.concatenate(([0], np.cumsum(size)))
            logs = np.concatenate(([0.0], np.cumsum(np.log10(c + 0.1))))
            known = np.concatenate(([0], np.cumsum(c > 0)))
            n_tokens.append(size + 1)
            n_known.append(np.diff(known[end]) + (ends > 0))
            plain.append(np.diff(logs[end]) + math.log10(ends + 0.1) - (size + 1) * scale)
            own, length = _codes(texts[i:j])
            stop = np.concatenate(([0], np.cumsum(length)))
            model.append(np.diff(np.concatenate(([0.0], np.cumsum(_found(own, code, value))))[stop]))
        out = pd.DataFrame({"doc_id": frame["doc_id"], "held_out": frame["held"]})
        out["n_tokens"], out["n_known"] = np.concatenate(n_tokens), np.concatenate(n_known)
        out["train_tokens"] = n_all
        out["base_score"], out["score"] = np.concatenate(plain), np.concatenate(model)
        return out

    return id_long(grouped.groupBy("grp").cogroup(answered(rows, sums, low).groupBy("grp")).applyInPandas(work, SCORES))


def _token_totals(frame: pd.DataFrame) -> pd.DataFrame:
    count = np.array(list(_added_words(frame).values()), np.int64)
    return pd.DataFrame({"n": [int(count.sum())], "v": [int((count > 0).sum())]})
