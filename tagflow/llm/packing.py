"""Operator 7: packing by best-fit decreasing.

Documents longer than a window are cut into full windows first. What remains is dealt into
groups of bounded size; in each group the pieces are placed longest first into the tightest
open window, found by a segment tree over remaining capacities.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagflow.llm.bpe import encode_words, texts_of, vocabulary
from tagflow.llm.common import id_long, id_text, parts, text_bytes, units
from tagflow.llm.pretokens import split_words

PIECES = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long"
#: Text bytes whose pieces one packing task places.
GROUP_BYTES = 96 << 20
#: Text bytes that a task holds as ids at once.
UNIT_BYTES = 6 << 20


class CapacityTree:
    """Open windows by remaining capacity; finds the smallest capacity that holds a piece."""

    def __init__(self, size: int) -> None:
        self.width = 1 << size.bit_length()
        self.count = [0] * (2 * self.width)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        k = capacity + self.width
        while k:
            self.count[k] += 1
            k >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) of the tightest open window with room."""
        k = least + self.width
        if not self.count[k]:
            while k > 1 and (k & 1 or not self.count[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.width:
                k = 2 * k if self.count[2 * k] else 2 * k + 1
        capacity = k - self.width
        window = self.open[capacity].pop()
        while k:
            self.count[k] -= 1
            k >>= 1
        return capacity, window


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of every piece (each at most `size` long)."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, made = CapacityTree(size), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        found = tree.take(n)
        if found is None:
            found = (size, made)
            made += 1
        room, window[k] = found
        offset[k] = size - room
        if room > n:
            tree.add(room - n, int(window[k]))
    return window, offset


def pieces(docs: DataFrame, path: str, size: int) -> DataFrame:
    """Full windows and remainders of every document's ids, an end id 0 included."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(path)
        for unit in units(batches, UNIT_BYTES):
            ids, count = encode_words(vocab, split_words(texts_of(unit), vocab.special))
            rows, at = [], 0
            for doc, n in zip(unit["doc_id"].tolist(), count.tolist(), strict=True):
                own = np.concatenate((ids[at : at + n], [0])).astype("<u4").tobytes()
                at += n
                for begin in range(0, n + 1, size):
                    length = min(size, n + 1 - begin)
                    rows.append((doc, begin, length, zlib.crc32(own[4 * begin : 4 * (begin + length)]), n + 1))
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return id_text(docs.select("doc_id", "text")).mapInPandas(work, PIECES)


def pack(docs: DataFrame, path: str, size: int = 1024, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Pack the ids of all documents into sequences of at most `size`.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null
    or empty text is the end id alone; equal rows are packed separately; an empty table gives no
    rows; extra columns are ignored; a null doc_id stays null. Groups are dealt by a hash of the piece, in number by the
    bytes of all texts and the rows; a group leaves at most a few windows partly filled. A very long text is encoded
    by itself in one task, with memory in proportion to its bytes.
    """
    groups = parts(text_bytes(docs), group_bytes)

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        window, offset = best_fit(frame["length"].to_numpy(np.int64), size)
        frame["sequence_id"] = frame.pop("grp").iloc[0] * (1 << 32) + window
        frame["offset"] = offset
        return frame

    dealt = pieces(docs, path, size).withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)).cast("long"))
    return id_long(dealt.groupBy("grp").applyInPandas(place, PIECES + ", sequence_id long, offset long"))
