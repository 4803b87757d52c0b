"""Operator 12: removal of repeated word windows by prefix-partitioned suffix trees.

1. Prefixes of suffixes are counted, one word first; a prefix that may have more than `most` suffixes is too large for a group
   and is counted with one word more, and so on. A prefix that is still too large at the full window is one deep node, and
   its smallest document settles its suffixes at once.
2. Every suffix goes to the group of its shortest prefix that is small enough, with a digest of its window for what lies
   below the prefix. Suffixes alone with their digest, or in one document, hang on no deep node and are retired.
3. For the others the words of the window are read and sorted within their group: the sorted suffixes and their common
   prefixes (LCP) are the subtree, and its nodes of the full depth are the repeats. A suffix under a node that a smaller
   document holds too loses its window.

Copies of a whole text are known from their digest and read no further. Group numbers and sizes follow the number of words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import SALT_ROWS, looked_up, parts, release, runs, text_bytes, units, written

#: Bytes of text behind a group of suffixes, and the share of a group that one prefix may fill.
GROUP_BYTES, SHARE = 8 << 20, 4
#: Bytes of text that a task cuts into suffixes at once (a longer text is alone).
UNIT_BYTES = 4 << 20
#: Bytes that a word and its blank have at least, and the prefixes of one length that are too large at most.
WORD_BYTES, LARGEST = 2, 1 << 20
#: Words whose hashes a task keeps.
KEPT = 1 << 20
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _C[0]
    x = (x ^ (x >> np.uint64(29))) * _C[1]
    return x ^ (x >> np.uint64(32))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def words_of(text: object) -> list[bytes]:
    """Words as UTF-8 (blanks are the ASCII ones alone)."""
    return text.encode().split() if isinstance(text, str) else []


class Laid:
    """The words of some texts end to end as hashes, and the suffixes that hold a whole window: `at`, their text `doc` and place `pos`."""

    def __init__(self, texts: pd.Series, least: int, known: _Hashes) -> None:
        self.least = least
        if len(known) > KEPT:
            known.clear()
        lists = [words_of(t) for t in texts]
        self.size = np.fromiter(map(len, lists), np.int64, len(lists))
        self.begin = np.cumsum(self.size) - self.size
        flat = np.fromiter(map(known.__getitem__, chain.from_iterable(lists)), np.uint64, self.size.sum())
        self.words = np.concatenate((flat, np.zeros(least, np.uint64)))
        room = np.maximum(self.size - least + 1, 0)
        self.doc = np.repeat(np.arange(len(lists)), room)
        self.pos = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)
        self.at = self.begin[self.doc] + self.pos

    def keep(self, chosen: np.ndarray) -> None:
        self.doc, self.pos, self.at = self.doc[chosen], self.pos[chosen], self.at[chosen]


def _longer(prefix: np.ndarray | None, laid: Laid, at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of prefixes of `length` words from those one word shorter."""
    word = _mixed(laid.words[at + length - 1])
    return word if prefix is None else _mixed(prefix * _C[2] + word)


def _among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def prefixes(laid: Laid, large: list[np.ndarray]) -> np.ndarray:
    """Of every suffix the hash of its shortest prefix that is not too large (of the whole window where all are)."""
    out = np.zeros(len(laid.at), np.uint64)
    left = np.arange(len(laid.at))
    have: np.ndarray | None = None
    for length in range(1, min(len(large) + 1, laid.least) + 1):
        have = _longer(have, laid, laid.at[left], length)
        out[left] = have
        if length > len(large):
            break
        again = _among(have, large[length - 1])
        left, have = left[again], have[again]
        if not len(left):
            break
    return out


def windows(laid: Laid, least: int) -> np.ndarray:
    """Hashes of whole windows, other than those of prefixes."""
    out = np.full(len(laid.at), least, np.uint64)
    for k in range(least):
        out = (out ^ laid.words[laid.at + k]) * _C[1]
        out ^= out >> np.uint64(31)
    return _mixed(out)


def _prefix_counts(laid: Laid, least: int, enough: float) -> Iterator[pd.DataFrame]:
    """Prefixes of every length with at least `enough` suffixes among these; longer ones only of those."""
    have: np.ndarray | None = None
    for length in range(1, least + 1):
        have = _longer(have, laid, laid.at, length)
        h, inverse, n = np.unique(have, return_inverse=True, return_counts=True)
        often = n >= enough
        if not often.any():
            return
        yield pd.DataFrame({"length": length, "h": h[often].view(np.int64), "n": n[often]})
        again = often[inverse]
        laid.keep(again)
        have = have[again]


def too_large(docs: DataFrame, least: int, most: int, total: int) -> list[np.ndarray]:
    """Sorted hashes of prefixes of 1, 2, ... words: all that have more than `most` suffixes, and none with less than half of that.

    One pass: a task tells only of prefixes that have their share of `most / 2` in its bytes (of `total`), so what goes
    untold of any prefix is less than `most / 2`. There are at most 2 * (suffixes / most) of each length.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        for unit in units(batches, UNIT_BYTES):
            size = sum(len(t.encode()) for t in unit["text"])
            yield from _prefix_counts(Laid(unit["text"], least, known), least, most / 2 * size / total)

    counts = docs.select("text").mapInPandas(work, "length int, h long, n long").groupBy("length", "h").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") >= most / 2).select("length", "h").toPandas()
    large: list[np.ndarray] = []
    for length in range(1, least + 1):
        h = found["h"][found["length"] == length].to_numpy(np.int64).view(np.uint64)
        if not len(h):
            break
        large.append(np.sort(h))
    return large


def smallest_documents(docs: DataFrame, least: int, large: list[np.ndarray]) -> np.ndarray:
    """Of every whole window that is too large the smallest document that holds it (nothing, if none is)."""
    if len(large) < least:
        return np.zeros(0, np.int64)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Hashes()
        for unit in units(batches, UNIT_BYTES):
            laid = Laid(unit["text"], least, known)
            prefix = prefixes(laid, large)
            full = _among(prefix, large[-1])
            found = pd.DataFrame({"h": prefix[full].view(np.int64), "first": unit["doc_id"].to_numpy(np.int64)[laid.doc[full]]})
            yield found.groupby("h", as_index=False).min()

    lows = docs.select("doc_id", "text").mapInPandas(work, "h long, first long").groupBy("h").agg(F.min("first").alias("first")).toPandas()
    return lows.set_index(lows["h"].to_numpy(np.int64).view(np.uint64))["first"].loc[large[-1]].to_numpy(np.int64)


def _planes(x: np.ndarray) -> bytes:
    """Integers as byte planes apart: small ones compress to little."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unplanes(raw: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _packed(bucket: np.ndarray, doc: np.ndarray, pos: np.ndarray, ids: np.ndarray, marks: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[dict]:
    """One row for each bucket, entries in the order of documents; ids and places are steps from the one before."""
    order = np.argsort(bucket, kind="stable")
    head = runs(bucket[order])
    for i, j in zip(head, [*head[1:], len(order)], strict=False):
        o = order[i:j]
        own, p = doc[o], pos[o].astype(np.int64)
        first = runs(own)
        step = np.diff(p, prepend=0)
        step[first] = p[first]
        row = {"bucket": int(bucket[o[0]]), "ids": _planes(np.diff(ids[own[first]], prepend=0)), "marks": marks[own[first]].astype("<i4").tobytes(), "counts": _planes(np.diff([*first, len(o)]).astype("<u4"))}
        yield row | {"pos": _planes(step.astype("<u4"))} | {k: v[o].tobytes() for k, v in columns.items()}


def _places(raw: bytes, counts: np.ndarray) -> np.ndarray:
    step = _unplanes(raw, "<u4").astype(np.int64)
    total = np.cumsum(step)
    begin = np.cumsum(counts) - counts
    return total - np.repeat(total[begin] - step[begin], counts)


def _entries(frame: pd.DataFrame, kinds: dict[str, str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Ids and marks of documents, the document and place of every entry, and the other columns."""
    counts = [_unplanes(x, "<u4").astype(np.int64) for x in frame["counts"]]
    pos = np.concatenate([_places(x, c) for x, c in zip(frame["pos"], counts, strict=True)]).astype(np.uint32)
    ids = np.concatenate([np.cumsum(_unplanes(x, "<i8")) for x in frame["ids"]])
    marks = np.frombuffer(b"".join(frame["marks"]), np.int32)
    return ids, marks, np.repeat(np.arange(len(ids)), np.concatenate(counts)), pos, {k: np.frombuffer(b"".join(frame[k]), v) for k, v in kinds.items()}


PACKED = "bucket long, ids binary, marks binary, counts binary, pos binary"


def _dealt(doc: np.ndarray, pos: np.ndarray, ids: np.ndarray, marks: np.ndarray, columns: dict[str, np.ndarray], buckets: int) -> pd.DataFrame:
    """Entries packed by a bucket of their document."""
    bucket = (_mixed(ids[doc].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(doc, kind="stable")
    rows = _packed(bucket[order], doc[order], pos[order], ids, marks, {k: v[order] for k, v in columns.items()})
    return pd.DataFrame(rows, columns=["bucket", "ids", "marks", "counts", "pos", *columns])


def _per_document(rows: DataFrame, kinds: dict[str, str], names: list[str], pick: Callable) -> DataFrame:
    """One row for each document (doc_id, mark) with entries; of each name the places that `pick` (columns to masks) says."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        ids, marks, doc, pos, c = _entries(frame, kinds)
        order = np.lexsort((pos, marks[doc], ids[doc]))
        i, m, p = ids[doc][order], marks[doc][order], pos[order]
        head = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (m[1:] != m[:-1]))))
        found = {"doc_id": i[head], "mark": m[head]}
        for name, used in zip(names, pick(c), strict=True):
            u = used[order] if used is not None else np.ones(len(order), bool)
            found[name] = [p[a:b][u[a:b]].tobytes() for a, b in zip(head, [*head[1:], len(order)], strict=False)]
        return pd.DataFrame(found)

    return rows.groupBy("bucket").applyInPandas(work, ", ".join(["doc_id long, mark int", *(f"{k} binary" for k in names)]))


def _classes(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest document among the entries of equal key."""
    order = np.argsort(key, kind="stable")
    head = runs(key[order])
    size = np.diff(np.concatenate((head, [len(key)])))
    low, high = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
    if len(key):
        low[order] = np.repeat(np.minimum.reduceat(doc[order], head), size)
        high[order] = np.repeat(np.maximum.reduceat(doc[order], head), size)
    return low, high


def dealt_suffixes(docs: DataFrame, least: int, groups: int, large: list[np.ndarray], first: np.ndarray) -> DataFrame:
    """All suffixes by the group of their prefix; those of a window that is too large by itself are settled (`known`: it goes)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for unit in units(batches, UNIT_BYTES):
            ids, marks = unit["doc_id"].to_numpy(np.int64), unit["mark"].to_numpy(np.int32)
            laid = Laid(unit["text"], least, hashes)
            if not len(laid.at):
                continue
            prefix = prefixes(laid, large)
            group = (prefix % np.uint64(groups)).astype(np.int64)
            known = np.zeros(len(group), np.uint8)
            if len(first):
                full = np.flatnonzero(_among(prefix, large[-1]))
                goes = ids[laid.doc[full]] > first[np.searchsorted(large[-1], prefix[full])]
                known[full[goes]] = 1
                group[full] = (_mixed(ids[laid.doc[full]].view(np.uint64)) % np.uint64(groups)).astype(np.int64)
                used = np.ones(len(group), bool)
                used[full[~goes]] = False
                laid.keep(used)
                group, known = group[used], known[used]
            digest = windows(laid, least).astype(np.uint32)
            for row in _packed(group, laid.doc, laid.pos, ids, marks, {"digest": digest, "known": known}):
                yield pd.DataFrame([row])

    return docs.mapInPandas(work, f"{PACKED}, digest binary, known binary")


def active(rows: DataFrame, buckets: int) -> DataFrame:
    """Per document the places of settled windows (`full`) and of suffixes that may hang on a deep node (`open`)."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        ids, marks, doc, pos, c = _entries(frame, {"digest": "u4", "known": "u1"})
        known = c["known"] > 0
        test = np.flatnonzero(~known)
        low, high = _classes(c["digest"][test], ids[doc[test]])
        used = known.copy()
        used[test] = low != high
        return _dealt(doc[used], pos[used], ids, marks, {"full": known[used]}, buckets)

    dealt = rows.groupBy("bucket").applyInPandas(work, f"{PACKED}, full binary")
    return _per_document(dealt, {"full": "?"}, ["full", "open"], lambda c: (c["full"], ~c["full"]))


def opened(found: DataFrame, least: int, groups: int, large: list[np.ndarray]) -> DataFrame:
    """The windows of open suffixes by group: 8 bits of every word, and a digest of 64 bits; `found` has doc_id, mark, text, open."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for unit in units(batches, UNIT_BYTES):
            ids, marks = unit["doc_id"].to_numpy(np.int64), unit["mark"].to_numpy(np.int32)
            laid = Laid(unit["text"], least, hashes)
            places = [np.unique(np.frombuffer(x, np.uint32)).astype(np.int64) for x in unit["open"]]
            laid.doc = np.repeat(np.arange(len(unit)), [len(x) for x in places])
            laid.pos = np.concatenate(places)
            laid.at = laid.begin[laid.doc] + laid.pos
            prefix = prefixes(laid, large)
            window = np.lib.stride_tricks.sliding_window_view(laid.words.astype(np.uint8), least)[laid.at]
            columns = {"digest": windows(laid, least), "window": np.ascontiguousarray(window)}
            for row in _packed((prefix % np.uint64(groups)).astype(np.int64), laid.doc, laid.pos, ids, marks, columns):
                yield pd.DataFrame([row])

    return found.mapInPandas(work, f"{PACKED}, digest binary, window binary")


def deep_nodes(window: np.ndarray, digest: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The subtree of a group as its sorted suffixes, and where its nodes of depth `least` begin.

    Neighbours that share all their words (and the digest below) are under one such node.
    """
    order = np.lexsort((digest, *window.T[::-1]))
    a, b = order[:-1], order[1:]
    same = window[a] == window[b]
    lcp = np.where(same.all(1), least, same.argmin(1))
    return order, np.flatnonzero(np.concatenate(([True], (lcp < least) | (digest[a] != digest[b]))))


def repeated(rows: DataFrame, least: int, buckets: int) -> DataFrame:
    """Per document the places of windows that a smaller document holds too."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        ids, marks, doc, pos, c = _entries(frame, {"digest": "u8", "window": "u1"})
        order, head = deep_nodes(c["window"].reshape(-1, least), c["digest"], least)
        own = ids[doc][order]
        low = np.repeat(np.minimum.reduceat(own, head), np.diff(np.concatenate((head, [len(order)]))))
        hit = order[own > low]
        return _dealt(doc[hit], pos[hit], ids, marks, {}, buckets)

    return _per_document(rows.groupBy("bucket").applyInPandas(work, PACKED), {}, ["span"], lambda c: (None,))


def text_copies(tagged: DataFrame) -> DataFrame:
    """doc_id and mark of the documents whose whole text a smaller document has."""
    rows = tagged.select("doc_id", "mark", F.unhex(F.sha2("text", 256)).alias("s"))
    least = rows.groupBy(F.col("s").alias("k")).agg(F.min("doc_id").alias("up"))
    found = looked_up(rows, "s", "doc_id", least, parts(rows.count(), SALT_ROWS))
    return found.where("doc_id > up").select("doc_id", "mark").distinct()


def kept_words(words: list[bytes], places: np.ndarray, least: int) -> list[bytes]:
    """The words that no window at one of the places covers."""
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + least, -1)
    free = np.cumsum(edge[:-1]) == 0
    return [w for w, f in zip(words, free.tolist(), strict=True) if f]


def removal_digest(docs: DataFrame, least: int = 13, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of `docs` (doc_id, text).

    Null and empty texts have no words; a null doc_id neither loses words nor makes others lose any; rows of one doc_id stay
    and are not repeats of each other; an empty table gives no rows; extra columns are ignored. A very long text is cut
    into suffixes by itself in one task, with memory of about 60 bytes for each of its words.
    """
    total = text_bytes(docs)
    groups = parts(total, group_bytes, 4)
    most = max(group_bytes // WORD_BYTES // SHARE // 4, total // WORD_BYTES // LARGEST, 1)
    wide = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tagged = wide.withColumn("mark", F.hash("text"))
    usable = tagged.where("doc_id IS NOT NULL AND text IS NOT NULL")
    large = too_large(usable, least, most, total)
    first = smallest_documents(usable, least, large)
    settled = active(dealt_suffixes(usable, least, groups, large, first), groups)
    copies = written(text_copies(usable)).withColumn("copy", F.lit(True))
    settled = settled.join(copies, ["doc_id", "mark"], "full_outer")
    settled = written(settled.withColumn("open", F.when(F.col("copy").isNull(), F.col("open"))))
    for _ in range(2):  # what the last job used is free after the second
        release(docs.sparkSession)
    asks = settled.where(F.length("open") > 0).select("doc_id", "mark", "open")
    # the same exchange of the texts serves this join and the last one
    windows_of = opened(usable.join(asks.hint("merge"), ["doc_id", "mark"]), least, groups, large)
    both = settled.select("doc_id", "mark", "full", "copy").join(repeated(windows_of, least, groups), ["doc_id", "mark"], "left")
    nothing = tagged.where("doc_id IS NULL OR text IS NULL").select("doc_id", "mark", "text", F.lit(None).cast("binary").alias("full"), F.lit(None).cast("boolean").alias("copy"), F.lit(None).cast("binary").alias("span"))
    out = usable.join(both.hint("merge"), ["doc_id", "mark"], "left").select(*nothing.columns).unionByName(nothing)

    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string")
    def digest(text: pd.Series, full: pd.Series, copy: pd.Series, span: pd.Series) -> pd.DataFrame:
        rows = []
        for t, f, whole, s in zip(text, full, copy, span, strict=True):
            words = words_of(t)
            if whole is True or whole == 1:
                kept = words if len(words) < least else []
            else:
                places = np.concatenate([np.frombuffer(x if x is not None else b"", np.uint32) for x in (f, s)]).astype(np.int64)
                kept = kept_words(words, places, least) if len(places) else words
            rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])

    return out.select("doc_id", digest.asNondeterministic()("text", "full", "copy", "span").alias("d")).select("doc_id", "d.*")
