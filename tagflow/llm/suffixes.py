"""Operator 4: removal of repeated byte strings by distributed prefix doubling.

A byte is removed if a string of `least` bytes that covers it also starts in a document with a
smaller doc_id. Sorting all suffixes would move every byte position; here only anchors are
ranked: the positions whose 16-byte hash is smallest in some window of `least` bytes. Equal
strings of `least` bytes hold the same anchor at the same place, so no repeat is lost.

1. Rank of 16 bytes: anchors meet by hash in buckets, are sorted, and those whose class lies
   in a single document are dropped (unique).
2. The rank is doubled to 33 bytes, to the left and to the right; a string of 50 bytes holds one
   of the two. Anchors that are unique now are dropped. The pair of the first rank and that of
   the whole surrounding (all strings through the anchor) settles the inside of copies at once.
3. Past the threshold: for what remains, the bytes around the anchor are read again and every
   string of `least` bytes through it is ranked and sorted with its doc_id.

Ranks are names from 64-bit hashes, so equal names mean equal strings but for a hash collision
within one bucket and class. Buckets grow in number with the bytes of all texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import checkpointed, parts, release, runs, text_bytes, units

SEED_BYTES = 16
#: Text bytes behind one bucket of anchors.
BUCKET_BYTES = 24 << 20
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _C[0]
    x = (x ^ (x >> np.uint64(29))) * _C[1]
    return x ^ (x >> np.uint64(32))


def _name(words: np.ndarray, at: np.ndarray, begin: int, stop: int) -> np.ndarray:
    """64-bit name of the bytes [begin, stop) around each position; `words` are 8-byte reads at every byte."""
    out = np.full(len(at), stop - begin, np.uint64)
    for k in [*range(begin, stop - 8, 8), stop - 8]:
        out = (out ^ words[at + k]) * _C[2]
        out ^= out >> np.uint64(31)
    return _mixed(out)


def _sliding(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """op over x[i : i + width] for every i, by doubling."""
    have = 1
    while 2 * have <= width:
        x = op(x[:-have], x[have:])
        have *= 2
    return x if have == width else op(x[: -(width - have)], x[width - have :])


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at every offset as one integer."""
    wide = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    return np.ascontiguousarray(wide).view(np.uint64).ravel()


class Laid:
    """Texts laid end to end with zero bytes between, so that reads around a position never meet another text."""

    def __init__(self, texts: list[bytes], gap: int) -> None:
        blank = bytes(gap)
        self.data = np.frombuffer(blank + blank.join(texts) + blank + bytes(16), np.uint8)
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begin = gap + np.cumsum(self.size + gap) - (self.size + gap)
        self.words = _words(self.data)


def anchors(laid: Laid, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buffer positions of the anchors, their text numbers and their 16-byte hashes."""
    width = least - SEED_BYTES + 1
    w = laid.words
    h = _mixed(w[:-8] ^ _mixed(w[8:] + _C[3]))
    low = _sliding(h, width, np.minimum)
    whole = np.zeros(len(low), bool)
    edge = np.zeros(len(low) + 1, np.int8)
    long = laid.size >= least
    np.add.at(edge, laid.begin[long], 1)
    np.add.at(edge, np.minimum(laid.begin[long] + laid.size[long] - least + 1, len(low)), -1)
    whole[:] = np.cumsum(edge[:-1], dtype=np.int8) > 0
    low[~whole] = 0
    high = _sliding(np.concatenate((np.zeros(width - 1, np.uint64), low)), width, np.maximum)
    at = np.flatnonzero((high == h[: len(high)]) & (high != 0))
    return at, np.searchsorted(laid.begin, at, "right") - 1, h[at]


def _packed(bucket: np.ndarray, doc: np.ndarray, ids: np.ndarray, marks: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[dict]:
    """One row for each bucket: the columns of its entries as bytes, entries in the order of documents."""
    order = np.argsort(bucket, kind="stable")
    head = runs(bucket[order])
    for i, j in zip(head, [*head[1:], len(order)], strict=False):
        o = order[i:j]
        own = doc[o]
        first = runs(own)
        row = {"bucket": int(bucket[o[0]]), "ids": ids[own[first]].tobytes(), "marks": marks[own[first]].tobytes(), "counts": np.diff([*first, len(o)]).astype(np.int32).tobytes()}
        yield row | {k: v[o].tobytes() for k, v in columns.items()}


def _unpacked(frame: pd.DataFrame, kinds: dict[str, str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    ids = np.frombuffer(b"".join(frame["ids"]), np.int64)
    marks = np.frombuffer(b"".join(frame["marks"]), np.int64)
    counts = np.frombuffer(b"".join(frame["counts"]), np.int32)
    return ids, marks, np.repeat(np.arange(len(ids)), counts), {k: np.frombuffer(b"".join(frame[k]), v) for k, v in kinds.items()}


FIRST = {"h": "u4", "x": "u8", "r": "u1", "l": "u1", "pos": "u4"}
LAST = {"h": "u8", "pos": "u4", "lo": "u1", "hi": "u1"}


def _schema(names: list[str]) -> str:
    return ", ".join(["bucket long", *(f"{k} binary" for k in ("ids", "marks", "counts", *names))])


def _sub(texts: list[bytes], most: int = 2 << 20) -> Iterator[tuple[int, list[bytes]]]:
    begin = 0
    while begin < len(texts):
        stop, size = begin, 0
        while stop < len(texts) and (stop == begin or size + len(texts[stop]) <= most):
            size += len(texts[stop])
            stop += 1
        yield begin, texts[begin:stop]
        begin = stop


def _bytes(frame: pd.DataFrame) -> list[bytes]:
    return [x.encode() if isinstance(x, str) else b"" for x in frame["text"]]


def anchor_rows(docs: DataFrame, least: int, buckets: int) -> DataFrame:
    """Anchors of all texts with their ranks, packed by bucket."""
    side, tail = least - SEED_BYTES, least
    half = (least + SEED_BYTES) // 2

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for unit in units(batches):
            ids, marks, found = unit["doc_id"].to_numpy(np.int64), unit["mark"].to_numpy(np.int64), []
            for begin, texts in _sub(_bytes(unit)):
                laid = Laid(texts, least)
                at, doc, h = anchors(laid, least)
                if not len(at):
                    continue
                pos = at - laid.begin[doc]
                left, right = np.minimum(pos, side), np.minimum(laid.size[doc] - pos, tail)
                x = _name(laid.words, at, -side, tail) + (left * 64 + right).astype(np.uint64) * _C[4]
                r, lf = _name(laid.words, at, 0, half), _name(laid.words, at, SEED_BYTES - half, SEED_BYTES)
                found.append((doc + begin, h, x, r.astype(np.uint8), lf.astype(np.uint8), pos.astype(np.uint32)))
            if found:
                doc, h, x, r, lf, pos = map(np.concatenate, zip(*found, strict=True))
                bucket = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                for row in _packed(bucket, doc, ids, marks, {"h": h.astype(np.uint32), "x": x, "r": r, "l": lf, "pos": pos}):
                    yield pd.DataFrame([row])

    return docs.mapInPandas(work, _schema(list(FIRST)))


def _spread(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest doc of each entry's class of equal keys."""
    order = np.argsort(key, kind="stable")
    head = runs(key[order])
    size = np.diff(np.concatenate((head, [len(key)])))
    low, high = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
    if len(key):
        d = doc[order]
        low[order] = np.repeat(np.minimum.reduceat(d, head), size)
        high[order] = np.repeat(np.maximum.reduceat(d, head), size)
    return low, high


def _dealt(doc: np.ndarray, ids: np.ndarray, marks: np.ndarray, columns: dict[str, np.ndarray], buckets: int) -> pd.DataFrame:
    """Entries packed by a bucket of their document: as many rows as buckets, whatever the number of documents."""
    bucket = (_mixed(ids[doc].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    return pd.DataFrame(_packed(bucket, doc, ids, marks, columns), columns=["bucket", "ids", "marks", "counts", *columns])


def _per_document(rows: DataFrame, kinds: dict[str, str], out: dict[str, str], pick) -> DataFrame:
    """One row for each document with entries, its chosen entries as bytes (`pick` gives values and a mask for each column)."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        ids, marks, doc, c = _unpacked(frame, kinds)
        order = np.lexsort((marks[doc], ids[doc]))
        i, m = ids[doc][order], marks[doc][order]
        head = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (m[1:] != m[:-1]))))
        found = {"doc_id": i[head], "mark": m[head]}
        for name, (value, used) in pick(c).items():
            v, u = value[order], used[order]
            found[name] = [v[a:b][u[a:b]].tobytes() for a, b in zip(head, [*head[1:], len(order)], strict=False)]
        return pd.DataFrame(found)

    return rows.groupBy("bucket").applyInPandas(work, ", ".join(["doc_id long, mark long", *(f"{k} {v}" for k, v in out.items())]))


def survivors(rows: DataFrame, buckets: int) -> DataFrame:
    """Per document: anchors settled by their surrounding (`full`) and those to be looked at (`open`)."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        ids, marks, doc, c = _unpacked(frame, FIRST)
        low, high = _spread(c["h"], ids[doc])
        kept = low != high
        doc, c = doc[kept], {k: v[kept] for k, v in c.items()}
        own, h = ids[doc], c["h"].astype(np.uint64) * _C[0]
        low, _ = _spread(_mixed(h ^ c["x"]), own)
        full = own > low
        opened = np.zeros(len(own), bool)
        lead = np.flatnonzero(~full)
        for side in ("r", "l"):
            low, high = _spread(h[lead] ^ c[side][lead].astype(np.uint64), own[lead])
            opened[lead] |= low != high
        used = full | opened
        return _dealt(doc[used], ids, marks, {"pos": c["pos"][used], "full": full[used]}, buckets)

    dealt = rows.groupBy("bucket").applyInPandas(work, _schema(["pos", "full"]))
    return _per_document(dealt, {"pos": "u4", "full": "?"}, {"full": "binary", "open": "binary"}, lambda c: {"full": (c["pos"], c["full"]), "open": (c["pos"], ~c["full"])})


def surroundings(found: DataFrame, least: int, buckets: int) -> DataFrame:
    """The bytes around every open anchor, packed by bucket; `found` has doc_id, mark, text, open."""
    side, tail = least - SEED_BYTES, least

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for unit in units(batches, 4 << 20):
            ids, marks = unit["doc_id"].to_numpy(np.int64), unit["mark"].to_numpy(np.int64)
            laid = Laid(_bytes(unit), least)
            pos = [np.frombuffer(x, np.uint32).astype(np.int64) for x in unit["open"]]
            doc = np.repeat(np.arange(len(unit)), [len(x) for x in pos])
            if not len(doc):
                continue
            pos = np.concatenate(pos)
            at = laid.begin[doc] + pos
            h = _mixed(laid.words[at] ^ _mixed(laid.words[at + 8] + _C[3]))
            around = np.lib.stride_tricks.as_strided(laid.data, (len(laid.data) - side - tail + 1, side + tail), (1, 1))[at - side]
            columns = {"h": h, "pos": pos.astype(np.uint32), "lo": np.minimum(pos, side).astype(np.uint8), "hi": np.minimum(laid.size[doc] - pos, tail).astype(np.uint8), "around": around}
            for row in _packed(((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), doc, ids, marks, columns):
                yield pd.DataFrame([row])

    return found.mapInPandas(work, _schema([*LAST, "around"]))


def spans(rows: DataFrame, least: int, buckets: int) -> DataFrame:
    """Per document the byte spans that smaller documents hold too, from all strings through open anchors."""
    side = least - SEED_BYTES

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        ids, marks, doc, c = _unpacked(frame, LAST)
        around = np.frombuffer(b"".join(frame["around"]) + bytes(16), np.uint8)
        words, row = _words(around), np.arange(len(doc)) * (side + least)
        own = ids[doc]
        first, last = np.full(len(doc), -1), np.full(len(doc), -1)
        for s in range(side + 1):
            whole = np.flatnonzero((s >= side - c["lo"].astype(np.int64)) & (s + least <= side + c["hi"].astype(np.int64)))
            key = _mixed(c["h"][whole] ^ _name(words, row[whole], s, s + least))
            low, _ = _spread(key, own[whole])
            hit = whole[own[whole] > low]
            last[hit] = s
            first[hit[first[hit] < 0]] = s
        used = first >= 0
        base = c["pos"].astype(np.int64) - side
        pair = np.stack((base + first, base + last + least), 1).astype(np.uint32)
        return _dealt(doc[used], ids, marks, {"begin": pair[used, 0], "stop": pair[used, 1]}, buckets)

    dealt = rows.groupBy("bucket").applyInPandas(work, _schema(["begin", "stop"]))
    return _per_document(dealt, {"begin": "u4", "stop": "u4"}, {"span": "binary"}, lambda c: {"span": (np.stack((c["begin"], c["stop"]), 1), np.ones(len(c["begin"]), bool))})


def merged(full: np.ndarray, span: np.ndarray, size: int, least: int) -> np.ndarray:
    """Maximal removed runs of a text of `size` bytes."""
    side = least - SEED_BYTES
    begin = np.concatenate((np.maximum(full.astype(np.int64) - side, 0), span[0::2].astype(np.int64)))
    stop = np.concatenate((np.minimum(full.astype(np.int64) + least, size), span[1::2].astype(np.int64)))
    if not len(begin):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(begin, kind="stable")
    begin, stop = begin[order], np.maximum.accumulate(stop[order])
    new = np.concatenate(([True], begin[1:] > stop[:-1]))
    return np.stack((begin[new], stop[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(stop) - 1]))]), 1)


def repeats(docs: DataFrame, least: int = 50, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every row of `docs` (doc_id, text and the columns `keep`) with its repeated byte spans as packed integers.

    Adds `full` and `span` (packed positions, null where nothing repeats). Rows are
    matched by doc_id and text. Null texts are empty; a null doc_id neither loses bytes nor
    makes others lose any; equal rows (one doc_id) are not repeats of each other.
    """
    total = text_bytes(docs)
    buckets = parts(total, BUCKET_BYTES, 4)
    wide = docs if dict(docs.dtypes)["doc_id"] == "bigint" else docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    tagged = wide.select("doc_id", "text", F.xxhash64("text").alias("mark"), *keep)
    usable = tagged.where("doc_id IS NOT NULL AND text IS NOT NULL")
    settled = checkpointed(survivors(anchor_rows(usable.select("doc_id", "text", "mark"), least, buckets), buckets))
    release(docs.sparkSession)
    asks = settled.where(F.length("open") > 0).select("doc_id", "mark", "open")
    # the same exchange of the texts serves this join and the last one, so all columns go along
    around = surroundings(usable.join(asks.hint("merge"), ["doc_id", "mark"]), least, buckets)
    both = settled.select("doc_id", "mark", "full").join(spans(around, least, buckets), ["doc_id", "mark"], "left")
    nothing = tagged.where("doc_id IS NULL OR text IS NULL").withColumn("full", F.lit(None).cast("binary")).withColumn("span", F.lit(None).cast("binary"))
    return usable.join(both.hint("merge"), ["doc_id", "mark"], "left").unionByName(nothing)


def _cuts(text: pd.Series, full: pd.Series, span: pd.Series, least: int) -> Iterator[tuple[bytes, np.ndarray]]:
    def flat(x: object) -> np.ndarray:
        return np.frombuffer(x if x is not None else b"", np.uint32)

    for t, f, s in zip(text, full, span, strict=True):
        raw = t.encode() if isinstance(t, str) else b""
        yield raw, merged(flat(f), flat(s), len(raw), least)


def _without(text: bytes, cut: np.ndarray) -> bytes:
    out, at = [], 0
    for i, j in cut.tolist():
        out.append(text[at:i])
        at = j
    return b"".join([*out, text[at:]])


def removal_digest(docs: DataFrame, least: int = 50) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of `docs`.

    Null texts are empty; a null doc_id neither loses bytes nor makes others lose any; equal rows stay and are not
    repeats of each other; an empty table gives no rows; extra columns are ignored. A very long text is cut into
    anchors by itself in one task, with memory of about 30 bytes for each of its bytes.
    """

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def digest(text: pd.Series, full: pd.Series, span: pd.Series) -> pd.DataFrame:
        rows = [(len(t), int((c[:, 1] - c[:, 0]).sum()), len(c), hashlib.sha256(_without(t, c)).hexdigest()) for t, c in _cuts(text, full, span, least)]
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = repeats(docs, least).select("doc_id", digest.asNondeterministic()("text", "full", "span").alias("d"))
    return found.select("doc_id", "d.*")


def remove_repeats(docs: DataFrame, least: int = 50) -> DataFrame:
    """`docs` with the repeated bytes taken out of `text` (and `n_chars` counted anew, if it is there).

    A character cut in two goes whole. Rows stay, also those left with an empty text; null texts stay null; other
    columns are as they were, whatever their names. Nulls, repeats and long texts otherwise as in `removal_digest`.
    """

    @F.pandas_udf("string")
    def rest(text: pd.Series, full: pd.Series, span: pd.Series) -> pd.Series:
        kept = [_without(t, c).decode("utf-8", "ignore") for t, c in _cuts(text, full, span, least)]
        return pd.Series([None if old is None else new for old, new in zip(text, kept, strict=True)], dtype=object)

    columns = docs.columns
    held = {c: f"held_{k}" for k, c in enumerate(columns) if c not in ("doc_id", "text")}
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(F.col(f"`{c}`").alias(h) for c, h in held.items()))
    out = repeats(plain, least, tuple(held.values())).withColumn("text", rest.asNondeterministic()("text", "full", "span"))
    if "n_chars" in held:
        out = out.withColumn(held["n_chars"], F.coalesce(F.length("text"), F.lit(0)).cast(dict(plain.dtypes)[held["n_chars"]]))
    return out.select(*(held.get(c, c) for c in columns)).toDF(*columns)
