"""Operator 10: byte-pair encoding and decoding with a pair occurrence index.

Inside a task the distinct words of a bounded run of texts are encoded together: an index
maps every adjacent pair to all its positions, active ranks are applied in ascending order,
and only the lists of the pairs next to a merge are updated. The vocabulary is a file of
fixed size that every worker reads once; no data leaves its partition.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tagflow.llm.common import id_long, id_text, units
from tagflow.llm.pretokens import Words, gather, split_words


def _byte_chars() -> dict[str, int]:
    """The printable stand-ins of the byte-level alphabet, by the public rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Merges and token bytes of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = _byte_chars()
        vocab = spec["model"]["vocab"]
        size = max([*vocab.values(), *(x["id"] for x in spec["added_tokens"])]) + 1
        self.bytes: list[bytes] = [b""] * size
        for word, k in vocab.items():
            self.bytes[k] = bytes(chars[c] for c in word) if all(c in chars for c in word) else word.encode()
        added = [x for x in spec["added_tokens"] if x["special"]]
        self.special = added[0]["content"] if added else None
        self.special_id = added[0]["id"] if added else -1
        if added:
            self.bytes[self.special_id] = self.special.encode()
        merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in spec["model"]["merges"]]
        pairs = np.array([[vocab[a], vocab[b], vocab[a + b]] for a, b in merges], np.int64)
        self.left, self.right, self.made = pairs.T
        keys = self.left << 20 | self.right
        self.order = np.argsort(keys)
        self.keys = np.concatenate((keys[self.order], [np.iinfo(np.int64).max]))
        self.rank_of = np.concatenate((self.order, [-1]))
        self.byte_id = np.zeros(256, np.int64)
        for c, b in chars.items():
            self.byte_id[b] = vocab[c]
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.offsets = np.concatenate(([0], np.cumsum([len(x) for x in self.bytes])))

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the pair never merges."""
        key = a << 20 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.rank_of[at], -1)


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_words(vocab: Vocabulary, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of every word (ragged: ids, offsets), by the pair occurrence index."""
    n = len(flat)
    token = vocab.byte_id[flat]
    following = np.arange(1, n + 1)
    before = np.arange(-1, n - 1)
    following[offsets[1:] - 1] = -1
    before[offsets[:-1]] = -1
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def enter(places: np.ndarray) -> None:
        """Add the pairs that start at these positions to their lists."""
        nxt = following[places]
        places, nxt = places[nxt >= 0], nxt[nxt >= 0]
        rank = vocab.ranks(token[places], token[nxt])
        kept = rank >= 0
        places, rank = places[kept], rank[kept]
        if not len(rank):
            return
        order = np.argsort(rank, kind="stable")
        places, rank = places[order], rank[order]
        cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        bounds = [0, *cut.tolist(), len(rank)]
        for i, r in enumerate(rank[bounds[:-1]].tolist()):
            if r in index:
                index[r].append(places[bounds[i] : bounds[i + 1]])
            else:
                index[r] = [places[bounds[i] : bounds[i + 1]]]
                heapq.heappush(active, r)

    enter(np.arange(n))
    while active:
        r = heapq.heappop(active)
        held = index.pop(r)
        at = held[0] if len(held) == 1 else np.concatenate(held)
        a, b, made = int(vocab.left[r]), int(vocab.right[r]), int(vocab.made[r])
        nxt = following[at]
        good = (token[at] == a) & (nxt >= 0) & (token[nxt] == b)
        at, nxt = at[good], nxt[good]
        if not len(at):
            continue
        if a == b:  # runs of one symbol merge from the left
            at = np.sort(at)
            taken, dead = [], -1
            for p, q in zip(at.tolist(), following[at].tolist(), strict=True):
                if p != dead:
                    taken.append(p)
                    dead = q
            at = np.array(taken)
            nxt = following[at]
        far = following[nxt]
        token[at] = made
        token[nxt] = -1
        following[at] = far
        before[far[far >= 0]] = at[far >= 0]
        prior = before[at]
        prior = prior[prior >= 0]
        enter(np.concatenate((prior[token[prior] != made], at)))
    alive = token >= 0
    count = np.concatenate(([0], np.cumsum(alive)))
    return token[alive], count[offsets]


def encode_words(vocab: Vocabulary, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts end to end, and the number of ids of each text."""
    ids, offsets = merge_words(vocab, words.flat, words.offsets)
    return expand(words, ids, offsets, vocab.special_id)


def expand(words: Words, ids: np.ndarray, offsets: np.ndarray, special_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Put each word's ids where the word stands."""
    ids = np.concatenate((ids, [special_id])).astype(np.uint32)
    offsets = np.concatenate((offsets, [len(ids)]))
    out, size = gather(ids, offsets, words.index)
    ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(words.per_text)))]
    return out, np.diff(ends)


def texts_of(frame: pd.DataFrame) -> list[str]:
    return [x if isinstance(x, str) else "" for x in frame["text"]]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Rows of doc_id, ids (array<int>) and decoded (string) for every row of `docs`.

    Null texts are empty and give no ids; repeated rows stay; a null doc_id stays null; an empty table gives
    no rows; other columns are dropped. A very long text is encoded by itself in one task: the pair index
    takes about 60 bytes of memory for a byte of its distinct words.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(path)
        for unit in units(batches):
            for frame, ids, count in _encoded(vocab, unit):
                cut = np.split(ids, np.cumsum(count)[:-1])
                yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": [x.astype(np.int32) for x in cut], "decoded": [decode(vocab, x) for x in cut]})

    return id_long(id_text(docs.select("doc_id", "text")).mapInPandas(work, "doc_id string, ids array<int>, decoded string"))


def _encoded(vocab: Vocabulary, unit: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    ids, count = encode_words(vocab, split_words(texts_of(unit), vocab.special))
    yield unit, ids, count


def decode(vocab: Vocabulary, ids: np.ndarray) -> str:
    """Text of a list of ids; broken byte sequences become replacement characters."""
    raw, _ = gather(vocab.flat, vocab.offsets, ids.astype(np.int64))
    return raw.tobytes().decode("utf-8", "replace")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row of `docs`: doc_id, n_tokens, ids_sha256, decoded_sha256, made inside the tasks.

    The same encoder and decoder as `encode`, and the same rows for nulls, empty and long texts, repeats,
    empty tables and extra columns; only digests leave the Python workers.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(path)
        for unit in units(batches):
            for frame, ids, count in _encoded(vocab, unit):
                ends = np.cumsum(count)
                rows = []
                for stop, n in zip(ends.tolist(), count.tolist(), strict=True):
                    part = ids[stop - n : stop]
                    rows.append((n, hashlib.sha256(part.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decode(vocab, part).encode("utf-8", "replace")).hexdigest()))
                out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
                out.insert(0, "doc_id", frame["doc_id"].to_numpy())
                yield out

    return id_long(id_text(docs.select("doc_id", "text")).mapInPandas(work, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"))
