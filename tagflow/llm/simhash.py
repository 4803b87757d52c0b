"""Operator 3: SimHash fingerprints linked by multi-index hashing.

A fingerprint of 64 bits is cut into segments. Two fingerprints that differ in at most r bits
differ in at most r // segments bits in one segment, so every fingerprint is put into a table
under each of its segments and probes that table with a small Hamming ball around the segment;
matches are verified over all bits. Rows for one segment value meet in a hash bucket; the number
of buckets grows with the data. Only distinct fingerprints are indexed, and a bucket returns
enough links to connect what belongs together, not all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.common import SALT_ROWS, connected_components, id_long, id_text, looked_up, parts, release, runs, text_bytes, units, written

SEED = 42
#: Text bytes behind one index bucket.
BUCKET_BYTES = 24 << 20
#: Classes that share a segment value and are still compared with each other; more are linked by the ball over their other bits.
HEAVY, HEAVY_VALUES = 4096, 50_000
#: Text bytes behind one index bucket of wide codes; least bits of their segments, and classes that may share a segment value on average.
CODE_BYTES, SEGMENT, SEGMENT_ROWS = 48 << 20, 16, 2000
#: Share of pairs exactly at the wanted similarity that may meet in no segment of the wide codes.
MISSED = 0.0055
#: Members of a group that are compared with each other, or with as many others, in one place.
GROUP_BLOCK = 256


def shingle_hashes(words: list[bytes], size: int) -> list[int]:
    """XXH64 of every run of `size` words, or of the whole sequence if it is shorter."""
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[i:j], SEED) for i, j in zip(begins.tolist(), ends[size - 1 :].tolist(), strict=True)]


def fingerprint(hashes: np.ndarray) -> int:
    """Bit k is set if it is set in over half of the hashes; no hashes give zero."""
    if not len(hashes):
        return 0
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every row; null texts have no words."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for unit in units(batches):
            found = [
                fingerprint(np.array(shingle_hashes(x.encode().lower().split() if isinstance(x, str) else [], words), np.uint64))
                for x in unit["text"]
            ]
            yield pd.DataFrame({"doc_id": unit["doc_id"], "fp": np.array(found, np.uint64).view(np.int64)})

    return id_long(id_text(docs.select("doc_id", "text")).mapInPandas(work, "doc_id string, fp long"))


def segments(count: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments of 64 bits."""
    cut = [64 * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:], strict=False)]


def ball(width: int, radius: int) -> np.ndarray:
    """All masks with 1 to `radius` bits set."""
    return np.array([sum(1 << b for b in bits) for r in range(1, radius + 1) for bits in combinations(range(width), r)], np.uint64)


def word_set(text: str | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    return np.unique(np.array(shingle_hashes(text.encode().lower().split() if isinstance(text, str) else [], words), np.uint64))


def codes(docs: DataFrame, words: int = 5, lanes: int = 4) -> DataFrame:
    """doc_id, a wide code of `64 * lanes` bits of the set of `words`-word shingles, and its size n."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for unit in units(batches):
            wide, n = [], []
            for x in unit["text"]:
                h = word_set(x, words)
                n.append(len(h))
                wide.append(b"".join(fingerprint(_lane(h, k)).to_bytes(8, "little") for k in range(lanes)))
            yield pd.DataFrame({"doc_id": unit["doc_id"], "code": wide, "n": n})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(work, "doc_id long, code binary, n int")


def _lane(h: np.ndarray, k: int) -> np.ndarray:
    """Another 64 bits of each hash."""
    x = (h + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


def heavy_values(classes: DataFrame, count: int) -> DataFrame:
    """Segment values (seg, value, n) that more than HEAVY classes share; HEAVY_VALUES of them at most."""
    own = F.array(*(F.struct(F.lit(k).alias("seg"), _value(k, count).alias("value")) for k in range(count)))
    each = classes.select(F.inline(own)).groupBy("seg", "value").agg(F.count("*").alias("n"))
    least = max(HEAVY, classes.count() * count // HEAVY_VALUES)
    return each.where(F.col("n") > least)


def _value(seg: int, count: int) -> F.Column:
    shift, width = segments(count)[seg]
    return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))


def heavy_links(classes: DataFrame, heavy: DataFrame, count: int) -> DataFrame:
    """Links (a, b) of classes within two bits that meet in a heavy segment value, for two segments.

    Classes that share the value are tables, those one bit off (with the bit set) probes. A table's other
    bits are entered as they are and with each one flipped, a probe's as they are: whatever meets is within
    two bits, and whatever is within two bits meets. At most 65 classes can share an entry.
    """
    out = []
    for seg, (shift, width) in enumerate(segments(count)):
        mask = (1 << width) - 1
        # as a signed long
        rest = F.col("fp").bitwiseAND(F.lit(~(mask << shift) if shift + width < 64 else (1 << shift) - 1))
        bits = [1 << b if b < 63 else -(1 << 63) for b in range(64) if not shift <= b < shift + width]
        entries = F.concat(F.array(rest), F.array(*(rest.bitwiseXOR(F.lit(b).cast("long")) for b in bits)))
        value = _value(seg, count)
        asks = [F.struct(value.alias("ask"), entries.alias("entries"))]
        for b in range(width):
            has = value.bitwiseAND(F.lit(1 << b).cast("long")) != 0
            asks.append(F.when(has, F.struct(value.bitwiseXOR(F.lit(1 << b).cast("long")).alias("ask"), F.array(rest).alias("entries"))))
        each = classes.select("v", F.inline(F.array_compact(F.array(*asks))))
        hot = heavy.where(F.col("seg") == seg).select(F.col("value").alias("hot"))  # at most HEAVY_VALUES rows
        met = each.join(F.broadcast(hot), each["ask"] == hot["hot"]).select("v", "ask", F.explode("entries").alias("entry"))
        same = met.groupBy("ask", "entry").agg(F.collect_set("v").alias("all")).where(F.size("all") > 1)
        out.append(same.select(F.explode("all").alias("a"), F.array_min("all").alias("b")).where("a <> b"))
    return reduce(DataFrame.unionByName, out).distinct()


def probes(classes: DataFrame, radius: int, count: int, buckets: int, heavy: list[np.ndarray]) -> DataFrame:
    """Index rows of each class (v, fp): tables and probes of one segment but for its heavy values, packed by bucket.

    Of two segments that differ in one bit, the one with the bit set probes the other.
    """
    cut = segments(count)
    flips = [ball(w, radius) for _, w in cut]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), 4096):
                part = batch.iloc[begin : begin + 4096]
                fp, v = part["fp"].to_numpy(np.int64).view(np.uint64), part["v"].to_numpy(np.int64)
                for k, (shift, width) in enumerate(cut):
                    own = (fp >> np.uint64(shift)) & np.uint64((1 << width) - 1)
                    value = np.concatenate((own[:, None], own[:, None] ^ flips[k][None, :]), axis=1)
                    used = np.ones(value.shape, bool)
                    if radius == 1:
                        used[:, 1:] = (own[:, None] & flips[k][None, :]) != 0
                    if len(heavy[k]):
                        used &= ~np.isin(value, heavy[k])
                    row, col = np.nonzero(used)
                    ask = value[row, col]
                    mix = (ask + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
                    bucket = ((mix >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")
                    head = runs(bucket[order])
                    for i, j in zip(head, [*head[1:], len(order)], strict=False):
                        o = order[i:j]
                        r = row[o]
                        columns = {"value": ask[o], "v": v[r], "fp": fp[r], "probe": col[o] > 0}
                        yield pd.DataFrame([{"bucket": int(bucket[o[0]]), "seg": k} | {c: x.tobytes() for c, x in columns.items()}])

    return classes.select("v", "fp").mapInPandas(work, "bucket long, seg int, value binary, v binary, fp binary, probe binary")


def _meetings(value: np.ndarray, probe: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (table entry, entry after it) with one segment value, in bounded pieces; sorted input, tables first."""
    head = runs(value)
    stop = np.repeat(np.concatenate((head[1:], [len(value)])), np.diff(np.concatenate((head, [len(value)]))))
    left = np.flatnonzero(~probe)
    many = stop[left] - left - 1
    begin = 0
    total = np.concatenate(([0], np.cumsum(many)))
    while begin < len(left):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] + most, "right")) - 1)
        n = many[begin:end]
        i = np.repeat(left[begin:end], n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        yield i, j
        begin = end


def _hook(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest reachable entry after adding links."""
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def links(classes: DataFrame, radius: int, count: int, buckets: int, limit: int) -> DataFrame:
    """Pairs (a, b) of classes, enough to connect all that meet in a segment and differ in at most `limit` bits.

    `radius` is the ball around a segment. Inside a bucket a forest of the links is returned, not all of
    them. Segment values of very many classes are left to `heavy_links` (two segments, a limit of two).
    """

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        value, v, fp = (np.frombuffer(b"".join(frame[c]), np.uint64) for c in ("value", "v", "fp"))
        probe = np.frombuffer(b"".join(frame["probe"]), bool)
        order = np.lexsort((probe, value))
        value, v, fp, probe = value[order], v[order].view(np.int64), fp[order], probe[order]
        names, at = np.unique(v, return_inverse=True)
        root = np.arange(len(names))
        for i, j in _meetings(value, probe):
            near = np.bitwise_count(fp[i] ^ fp[j]) <= limit
            root = _hook(root, at[i[near]], at[j[near]])
        moved = np.flatnonzero(root != np.arange(len(names)))
        return pd.DataFrame({"a": names[moved], "b": names[root[moved]]})

    skipped = [np.zeros(0, np.uint64)] * count
    dense = None
    if (radius, count, limit) == (1, 2, 2):
        heavy = written(heavy_values(classes, count))
        found = heavy.collect()  # at most HEAVY_VALUES rows
        if found:
            skipped = [np.array([r["value"] for r in found if r["seg"] == k], np.int64).view(np.uint64) for k in range(count)]
            dense = heavy_links(classes, heavy, count)
    out = probes(classes, radius, count, buckets, skipped).groupBy("bucket", "seg").applyInPandas(work, "a long, b long")
    return (out if dense is None else out.unionByName(dense)).distinct()


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of `docs`.

    Texts are lower-cased in A-Z and cut at ASCII white space. Null and empty texts have the
    fingerprint zero and link like any other; equal rows stay equal rows; a null doc_id stays
    null, takes the component of its fingerprint and never names one; extra columns are ignored; an empty
    table gives no rows. A very long text is hashed by itself in one task, with memory for its shingles.
    """
    buckets = parts(text_bytes(docs), BUCKET_BYTES, 4)
    # the fingerprints are read several times: they are small and written once
    prints = written(fingerprints(docs, words))
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("v")))
    count = max(2, (radius + 2) // 2)
    found = connected_components(links(classes.where("v IS NOT NULL"), radius // count, count, buckets, radius))
    named = classes.join(found, classes["v"] == found["id"], "left").select(F.col("fp").alias("k"), F.coalesce("component_id", "v").alias("up"))
    told = looked_up(prints, "fp", "doc_id", named, parts(prints.count(), SALT_ROWS))  # copies of one text are dealt by salts
    return told.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("up").alias("component_id"))


def similar_bits(similarity: float, lanes: int, errors: float = 5) -> int:
    """Bits in which codes of two shingle sets with this Jaccard similarity differ, `errors` standard errors added."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return round(64 * lanes * (share + errors * math.sqrt(share * (1 - share) / (64 * lanes))))


def code_shape(rows: int, similarity: float) -> tuple[int, int, int]:
    """Bits of a segment, their number, and lanes of the wide code, for so many documents.

    A segment's width follows the rows, so that the classes that share its value stay few; the number of
    segments follows from the width, so that a pair exactly at the similarity meets in one but for MISSED.
    """
    width = max(SEGMENT, math.ceil(math.log2(max(rows, 1) / SEGMENT_ROWS)))
    off = math.acos(2 * similarity / (1 + similarity)) / math.pi
    meet = (1 - off) ** width + width * off * (1 - off) ** (width - 1)
    count = math.ceil(math.log(MISSED) / math.log(1 - meet))
    return width, count, -(-width * count // 64)


def code_probes(classes: DataFrame, width: int, count: int, top: int) -> DataFrame:
    """Index rows of each class (v, code, n), packed by segment of `width` bits and its `top` highest bits.

    A class is put where its segment's highest bits say, and where they say with one set bit
    cleared; the ball over the other bits is made where they meet.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), 4096):
                part = batch.iloc[begin : begin + 4096]
                columns = {"v": part["v"].to_numpy(np.int64), "n": part["n"].to_numpy(np.int32)}
                columns["code"] = np.array([np.frombuffer(x, np.uint64) for x in part["code"]]).reshape(len(part), -1)
                out = []
                for seg in range(count):
                    head = _segment(columns["code"], seg, width) >> (width - top)
                    flip = np.concatenate(([0], 1 << np.arange(top)))
                    row, col = np.nonzero((head[:, None] & flip) == flip)
                    bucket = head[row] ^ flip[col]
                    order = np.argsort(bucket, kind="stable")
                    first = runs(bucket[order])
                    for i, j in zip(first, [*first[1:], len(order)], strict=False):
                        r = row[order[i:j]]
                        out.append({"bucket": int(bucket[order[i]]), "seg": seg} | {c: x[r].tobytes() for c, x in columns.items()})
                yield pd.DataFrame(out)

    return classes.select("v", "code", "n").mapInPandas(work, "bucket int, seg int, v binary, n binary, code binary")


def _segment(code: np.ndarray, seg: int, width: int) -> np.ndarray:
    """One segment of `width` bits (at most 62) of each code."""
    lane, shift = divmod(seg * width, 64)
    value = code[:, lane] >> np.uint64(shift)
    if shift + width > 64:
        value = value | code[:, lane + 1] << np.uint64(64 - shift)
    return (value & np.uint64((1 << width) - 1)).astype(np.int64)


def _forest(count: int, i: np.ndarray, j: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links of a spanning forest with the fewest differing bits (Boruvka's rounds)."""
    order = np.argsort(off, kind="stable")
    i, j, off = i[order], j[order], off[order]
    root, live, taken = np.arange(count), np.arange(len(i)), []
    while True:
        live = live[root[i[live]] != root[j[live]]]
        if not len(live):
            break
        best = np.full(count, len(i))
        np.minimum.at(best, root[i[live]], live)
        np.minimum.at(best, root[j[live]], live)
        pick = np.unique(best[best < len(i)])
        taken.append(pick)
        root = _hook(root, i[pick], j[pick])
    kept = np.concatenate([np.zeros(0, np.int64), *taken])
    return i[kept], j[kept], off[kept]


def code_pairs(classes: DataFrame, similarity: float, width: int, count: int, lanes: int, top: int) -> DataFrame:
    """Pairs (a, b) of classes to be compared exactly.

    Their codes agree in a segment but for one bit at most and differ in at most `similar_bits`, and
    the sizes of their sets allow the similarity. Each bucket gives a spanning forest of its pairs,
    which connects what all of them connect.
    """
    limit = similar_bits(similarity, lanes)

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        v, n = np.frombuffer(b"".join(frame["v"]), np.int64), np.frombuffer(b"".join(frame["n"]), np.int32)
        code = np.frombuffer(b"".join(frame["code"]), np.uint64).reshape(len(v), -1)
        own = _segment(code, int(frame["seg"].iloc[0]), width)
        home = np.flatnonzero(own >> (width - top) == int(frame["bucket"].iloc[0]))
        guest = np.setdiff1d(np.arange(len(v)), home, assume_unique=True)
        low = own & ((1 << (width - top)) - 1)
        flip = 1 << np.arange(width - top)
        row, col = np.nonzero(low[home][:, None] & flip)
        at = np.concatenate((home, guest, home[row]))
        value = np.concatenate((low[home], low[guest], low[home[row]] ^ flip[col]))
        probe = np.arange(len(at)) >= len(home)
        order = np.lexsort((probe, value))
        at, value, probe = at[order], value[order], probe[order]
        found = (np.zeros(0, np.int64),) * 3
        for i, j in _meetings(value, probe):
            i, j = at[i], at[j]
            good = np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-6
            i, j = i[good], j[good]
            off = np.zeros(len(i), np.int64)
            for lane in range(code.shape[1]):
                off += np.bitwise_count(code[i, lane] ^ code[j, lane])
                good = off <= limit
                i, j, off = i[good], j[good], off[good]
            if len(i):
                found = _forest(len(v), *(np.concatenate(x) for x in zip(found, (i, j, off), strict=True)))
        i, j, _ = found
        return pd.DataFrame({"a": np.minimum(v[i], v[j]), "b": np.maximum(v[i], v[j])})

    return code_probes(classes, width, count, top).groupBy("bucket", "seg").applyInPandas(work, "a long, b long").where("a <> b").distinct()


def shingle_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """id and own (the sorted hashes of the shingles) of the texts with these ids."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for unit in units(batches):
            yield pd.DataFrame({"id": unit["doc_id"], "own": [word_set(x, words).tobytes() for x in unit["text"]]})

    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return texts.join(ids, texts["doc_id"] == ids["id"], "left_semi").mapInPandas(work, "id long, own binary")


def verified(pairs: DataFrame, docs: DataFrame, similarity: float, words: int) -> DataFrame:
    """The pairs (a, b) of doc_ids whose shingle sets have this Jaccard similarity at least."""

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = np.zeros(len(batch), bool)
            for k, (x, y) in enumerate(zip(batch["x"], batch["y"], strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[k] = both / max(1, len(x) + len(y) - both) >= similarity
            yield batch.loc[good, ["a", "b"]]

    own = shingle_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), words)
    x, y = own.select(F.col("id").alias("a"), F.col("own").alias("x")), own.select(F.col("id").alias("b"), F.col("own").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInPandas(near, "a long, b long").distinct()


def _shared(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many elements every two sets have in common."""
    at = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, name, many = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = many[name] > 1  # the others are in one set only
    names, name = np.unique(name[often], return_inverse=True)
    order = np.argsort(name, kind="stable")
    at, name = at[often][order], name[order]
    both = np.zeros((len(sets), len(sets)))
    for k in range(0, len(names), width):
        i, j = np.searchsorted(name, (k, k + width))
        has = np.zeros((len(sets), width), np.float32)
        has[at[i:j], name[i:j] - k] = 1
        both += has @ has.T
    return both


def group_links(members: DataFrame, docs: DataFrame, similarity: float, words: int) -> DataFrame:
    """Links (a, b) that connect all similar members (id, grp, root) of each group; equal roots are connected already.

    A group is cut into blocks of GROUP_BLOCK members, and every pair of blocks is compared exactly.
    """

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        ids, root = frame["id"].to_numpy(np.int64), frame["root"].to_numpy(np.int64)
        sets = [np.frombuffer(x, np.uint64) for x in frame["own"]]
        size, both = np.array([len(x) for x in sets]), _shared(sets)
        near = both / np.maximum(1, size[:, None] + size[None, :] - both) >= similarity
        i, j = np.nonzero(np.triu(near & (root[:, None] != root[None, :]), 1))
        i, j, _ = _forest(len(ids), i, j, np.zeros(len(i), np.int64))
        return pd.DataFrame({"a": np.minimum(ids[i], ids[j]), "b": np.maximum(ids[i], ids[j])})

    blocks = members.groupBy(F.col("grp").alias("k")).agg(F.ceil(F.count("*") / GROUP_BLOCK).cast("int").alias("up"), F.min("root").alias("first"), F.max("root").alias("last")).where("first <> last").select("k", "up")
    dealt = looked_up(members, "grp", "id", blocks, parts(members.count(), SALT_ROWS)).where("up IS NOT NULL").withColumnRenamed("up", "blocks")
    cut = written(dealt.withColumn("own_block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    sets = shingle_sets(docs, cut.select("id").distinct(), words)
    each = cut.join(sets, "id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    each = each.select("id", "root", "own", "grp", F.least("own_block", "other").alias("lo"), F.greatest("own_block", "other").alias("hi"))
    return each.groupBy("grp", "lo", "hi").applyInPandas(work, "a long, b long").where("a <> b").distinct()


def near_links(classes: DataFrame, docs: DataFrame, similarity: float, words: int, shape: tuple[int, int, int], top: int) -> DataFrame:
    """Verified links (a, b) of the classes (v, code, n), enough to connect all candidates that are similar.

    First the forests of the buckets are verified. Where a link of theirs fails, what it should have
    connected may be similar by another pair: then all members of its tree are compared with each other.
    """
    pairs = written(code_pairs(classes, similarity, *shape, top))
    good = written(verified(pairs, docs, similarity, words))
    release(docs.sparkSession)
    if pairs.count() == good.count():
        return good
    tree, group = connected_components(pairs).withColumnRenamed("component_id", "grp"), connected_components(good)
    members = written(tree.join(group, "id", "left").select("id", "grp", F.coalesce("component_id", "id").alias("root")))
    return written(good.unionByName(group_links(members, docs, similarity, words)))


def keep_one(docs: DataFrame, similarity: float = 0.8, words: int = 5) -> DataFrame:
    """The rows of `docs` without near copies: of each group the smallest doc_id stays, with all its columns.

    Candidates are documents whose wide codes of the set of five-word shingles meet in one of their segments
    with at most one bit off (see `code_shape`); they are linked when the sets themselves have a Jaccard similarity
    of `similarity` or more. All texts without words (null, empty) are one group; rows with a null doc_id stay, and
    so do equal rows of a kept doc_id; an empty table stays empty; extra columns are as they were. A very long
    text is hashed by itself in one task, with memory for its set of shingles.
    """
    width, count, lanes = code_shape(docs.count(), similarity)
    top = min(width, (parts(text_bytes(docs), CODE_BYTES, 4) - 1).bit_length())
    named_docs = docs.where("doc_id IS NOT NULL")
    prints = written(codes(named_docs, words, lanes))
    classes = written(prints.groupBy("code", "n").agg(F.min("doc_id").alias("v")))
    found = connected_components(near_links(classes, named_docs, similarity, words, (width, count, lanes), top))
    named = classes.join(found, classes["v"] == found["id"], "left").select(F.struct("code", "n").alias("k"), F.coalesce("component_id", "v").alias("up"))
    told = looked_up(prints.select("doc_id", F.struct("code", "n").alias("set")), "set", "doc_id", named, parts(prints.count(), SALT_ROWS))
    gone = told.where("doc_id <> up").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")
