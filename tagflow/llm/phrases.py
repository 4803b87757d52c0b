"""Operator 11: phrase collocations from word-id suffix arrays, one for each shard of texts.

1. A shard's words get dense ids. Counts of single words and word pairs leave it as 64-bit hashes, and their global
   sums bound the count of every phrase from above: a phrase that is frequent is made of frequent pairs.
2. What may be frequent goes back to the shards as a bit map of at most MAP_BITS bits. A fuller map lets more phrases
   through; it never loses one.
3. Each shard sorts its suffixes by prefix doubling (ranks of 1, 2 and 4 words), and the LCP intervals give the counts of
   all phrases of up to 4 words inside the runs of pairs that may be frequent.
4. Counts are merged by phrase, and the rest (cuts, scores, containment, ranks) is joins and aggregates over the
   frequent phrases alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagflow.llm.common import written

#: Words of the longest phrase, and occurrences of a candidate.
LONGEST, LEAST = 4, 30
#: Language of rows that name none.
NO_LANG = "und"
#: Bits of a map for each entry, and of the largest map (32 MB).
ENTRY_BITS, MAP_BITS = 24, 1 << 28
CHUNK_BITS = 1 << 19
#: Bytes of text in a shard (a longer text is one by itself), and rows that leave it at once.
SHARD_BYTES, ROWS = 5 << 20, 1 << 17
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
#: Capitals become small letters, tabs blanks, and the ends of pieces full stops, which no word holds.
_PLAIN = bytes.maketrans(UPPER + b"\t" + b",;:!?\n\x0b\x0c\r", LOWER + b" " + b"." * 9)
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _C[0]
    x = (x ^ (x >> np.uint64(29))) * _C[1]
    return x ^ (x >> np.uint64(32))


class _Ids(dict):
    """Word ids in the order in which words are met; the end of a piece is 0."""

    def __init__(self) -> None:
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = out = len(self)
        return out


class Shard:
    """Texts (UTF-8) of one language as word ids; `at` holds the ids with an end (0) after every piece."""

    def __init__(self, lang: str, texts: list[bytes]) -> None:
        ids = _Ids()
        words = b" . ".join(texts).translate(_PLAIN).replace(b".", b" . ").split()
        self.at = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        del words
        self.at = np.concatenate((self.at, [0]))
        self.words = list(ids)
        seed = xxhash.xxh64_intdigest(lang.encode())
        self.hashes = _mixed(np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.words), np.uint64, len(ids)))
        self.counts = np.bincount(self.at, minlength=len(ids))
        self.counts[0] = 0
        self.pairs = np.flatnonzero((self.at[:-1] > 0) & (self.at[1:] > 0))

    def pair_hashes(self) -> np.ndarray:
        """Of every pair of words that stand side by side, by its first place (`pairs`)."""
        return _mixed(self.hashes[self.at[self.pairs]] * _C[2] + self.hashes[self.at[self.pairs + 1]])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Shard]]:
    """Shards of one language each; texts wait for others of their language while all that wait are within SHARD_BYTES."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text").cast(pa.binary()), strict=True):
            key, raw = lang.as_py(), text.as_py()
            held.setdefault(key, []).append(raw)
            size[key] = size.get(key, 0) + len(raw)
            total += len(raw)
            if total >= SHARD_BYTES:
                key = max(size, key=size.__getitem__)
                total -= size.pop(key)
                yield key, Shard(key, held.pop(key))
    for key, texts in held.items():
        yield key, Shard(key, texts)


def _rows(*columns: pa.Array, names: list[str]) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(columns[0]), ROWS):
        yield pa.RecordBatch.from_arrays([c.slice(i, ROWS) for c in columns], names)


def _hash_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and pairs of every shard as hashes with their counts; the number of words of its language has the hash null."""
    for lang, s in _shards(batches):
        pairs, n = np.unique(s.pair_hashes().view(np.int64), return_counts=True)
        own = s.counts > 0
        h, n = np.concatenate((s.hashes[own].view(np.int64), pairs)), np.concatenate((s.counts[own], n))
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([None], pa.int64()), pa.array([int(s.counts.sum())])], ["lang", "h", "n"])
        yield from _rows(pa.nulls(len(h), pa.string()), pa.array(h), pa.array(n), names=["lang", "h", "n"])


class BitMap:
    """Which hashes may be frequent: two bits for each."""

    def __init__(self, bits: int, chunks: dict[int, bytes]) -> None:
        self.mask = np.uint64(bits - 1)
        self.data = np.zeros(bits // 8, np.uint8)
        for k, x in chunks.items():
            self.data[k * (CHUNK_BITS // 8) :][: len(x)] = np.frombuffer(x, np.uint8)

    def __contains__(self, h: int) -> bool:
        return bool(self.has(np.array([h], np.uint64))[0])

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at in (h & self.mask, (h >> np.uint64(32)) & self.mask):
            out &= (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out


def bit_map(hashes: DataFrame, entries: int) -> BitMap:
    """The map of `hashes` (h); its pieces are made in tasks, and what reaches the driver is its MAP_BITS at most."""
    bits = min(MAP_BITS, max(CHUNK_BITS, 1 << (entries * ENTRY_BITS - 1).bit_length())) if entries else CHUNK_BITS
    mask = F.lit(bits - 1)
    places = hashes.select(F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 32).bitwiseAND(mask))).alias("at"))
    words = places.groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(at & 63 AS INT)))").alias("bits"))

    def laid(frame: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(min(bits, CHUNK_BITS) // 64, np.int64)
        first = int(frame["word"].iloc[0]) // (CHUNK_BITS // 64)
        out[frame["word"].to_numpy(np.int64) % (CHUNK_BITS // 64)] = frame["bits"].to_numpy(np.int64)
        return pd.DataFrame({"chunk": [first], "data": [out.tobytes()]})

    chunks = words.groupBy(F.floor(F.col("word") / (CHUNK_BITS // 64)).alias("_chunk")).applyInPandas(lambda frame: laid(frame), "chunk long, data binary")
    return BitMap(bits, {r.chunk: bytes(r.data) for r in chunks.collect()})


def suffix_counts(at: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Every phrase of 2 to LONGEST ids in `at` (0 ends a run): first places, words, and counts.

    Ranks of suffixes are doubled from 1 to 2 to 4 words; suffixes in the order of their last rank are the suffix array as
    far as LONGEST words, and an LCP interval of n words or more is one phrase of n words.
    """
    at = np.concatenate((at, np.zeros(LONGEST, np.int64)))
    size = len(at) - LONGEST
    rank = {1: at}
    for have in (1, 2):
        r = rank[have]
        left, right = r[:size], r[have : have + size]
        key = left * np.int64(r.max() + 1) + np.where(left > 0, right, 0)
        _, dense = np.unique(key, return_inverse=True)
        grown = np.zeros(len(at), np.int64)
        grown[:size] = dense.astype(np.int64) + 1
        grown[:size][left == 0] = 0
        rank[2 * have] = grown
    suffixes = np.argsort(rank[LONGEST][:size], kind="stable")
    suffixes = suffixes[at[suffixes] > 0]
    if not len(suffixes):
        return
    a, b = suffixes[:-1], suffixes[1:]
    # words that neighbours have in common, and words that each suffix has up to its end
    lcp = (at[a] == at[b]).astype(np.int64)
    room = np.ones(len(suffixes), np.int64)
    for n in range(1, LONGEST):
        lcp += (lcp == n) & (at[a + n] == at[b + n]) & (at[a + n] > 0)
        room += (room == n) & (at[suffixes + n] > 0)
    for n in range(2, LONGEST + 1):
        head = np.flatnonzero(np.concatenate(([True], lcp < n)))
        count = np.diff(np.concatenate((head, [len(suffixes)])))
        whole = room[head] >= n
        yield suffixes[head[whole]], n, count[whole]


def shard_phrases(lang: str, s: Shard, known: BitMap) -> Iterator[pa.RecordBatch]:
    """Counts of the shard's phrases that may be frequent."""

    def out(text: list[bytes], words: int, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(text), pa.string()), pa.array(text, pa.string()), pa.array([words] * len(text), pa.int32()), pa.array(n)], ["lang", "phrase", "words", "n"])

    often = known.has(s.hashes) & (s.counts > 0)
    one = np.flatnonzero(often)
    yield out([s.words[k] for k in one], 1, s.counts[one])
    linked = np.zeros(len(s.at), bool)  # the word and the next one are such a pair
    linked[s.pairs] = known.has(s.pair_hashes())
    inside = linked.copy()
    inside[1:] |= linked[:-1]
    # runs of such pairs, each with an end behind it
    place = np.flatnonzero(inside)
    if not len(place):
        return
    stop = ~linked[place]
    line = np.zeros(len(place) + int(stop.sum()), np.int64)
    line[np.arange(len(place)) + np.cumsum(stop) - stop] = s.at[place]
    for first, n, count in suffix_counts(line):
        for i in range(0, len(first), ROWS):
            parts = [[s.words[k] for k in line[first[i : i + ROWS] + j].tolist()] for j in range(n)]
            yield out([b" ".join(p) for p in zip(*parts, strict=True)], n, count[i : i + ROWS])


def frequent(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Words and phrases (lang, phrase, words, f) with f >= least, and the number of words of each language (lang, n)."""
    texts = docs.select("text", F.coalesce("lang", F.lit(NO_LANG)).alias("lang")).where("text IS NOT NULL")
    sums = texts.mapInArrow(_hash_counts, "lang string, h long, n long").groupBy("lang", "h").agg(F.sum("n").alias("n"))
    sums = written(sums.where(F.col("h").isNull() | (F.col("n") >= least)))
    totals = sums.where("h IS NULL").select("lang", "n")
    hashes = sums.where("h IS NOT NULL")
    shared = docs.sparkSession.sparkContext.broadcast(bit_map(hashes, hashes.count()))  # MAP_BITS at most

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, s in _shards(batches):
            yield from shard_phrases(lang, s, shared.value)

    counted = texts.mapInArrow(work, "lang string, phrase string, words int, n long").groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f"))
    return written(counted.where(F.col("f") >= least)), totals


def _part(phrase: Column, begin: Column, length: Column) -> Column:
    """`length` words of a phrase from word `begin` (from 1) on."""
    return F.array_join(F.slice(F.split(phrase, " "), begin, length), " ")


def _wide(n: Column) -> Column:
    """A count that may be multiplied: 20 digits hold it, 38 hold its products."""
    return n.cast("decimal(20,0)")


def scored(found: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, words, a) with l, r and score of their lowest cut; every part of one is in `found` itself."""
    long = found.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = long.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"head": _part(F.col("phrase"), F.lit(1), F.col("k")), "tail": _part(F.col("phrase"), F.col("k") + 1, F.col("words") - F.col("k"))})
    for side, name in (("head", "l"), ("tail", "r")):
        part = found.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(name))
        cuts = cuts.join(part, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))).drop("_lang", "_part")
    score = F.expr("CAST((CAST(a AS DECIMAL(20,0)) * CAST(2000000 AS DECIMAL(7,0))) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS LONG)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return cuts.groupBy("lang", "phrase", "words", "a").agg(best.alias("b")).select("lang", "phrase", "words", "a", "b.l", "b.r", "b.score")


def covering(found: DataFrame) -> DataFrame:
    """For every phrase of two words or more inside a longer candidate: the largest count of such a candidate (lang, inner, most)."""
    long = found.where("words > 2").select("lang", "phrase", "words", "f")
    spans = long.select("*", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("width"))
    starts = spans.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("width") + 1)).alias("start"))
    inner = starts.select("lang", _part(F.col("phrase"), F.col("start"), F.col("width")).alias("inner"), "f")
    return inner.groupBy("lang", "inner").agg(F.max("f").alias("most"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = 2000) -> DataFrame:
    """The first `top` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    `docs` has text and lang. Null and empty texts have no words; a null lang is `und`; doc_id is not read, so equal rows
    count each and a null id does not matter; an empty table gives no rows; extra columns are ignored. Ties are broken by
    count, then by the bytes of the phrase. A text is never cut: the longest one bounds the longest shard.
    """
    found, totals = frequent(docs, least)
    most = covering(found).withColumnRenamed("lang", "_lang")
    rest = scored(found).join(most, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("inner")), "left")
    kept = rest.where(F.col("most").isNull() | (_wide(F.col("most")) * 100 < _wide(F.col("a")) * 80))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = kept.withColumn("rank", place.cast("long")).where(F.col("rank") <= top)
    n = totals.select(F.col("lang").alias("_of"), "n")
    return ranked.join(n, F.col("lang") == F.col("_of")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
