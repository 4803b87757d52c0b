"""Byte-level pre-tokenisation of many texts at once with array operations.

The split is that of the pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
found from run boundaries of four character classes.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd

LETTER, NUMBER, SPACE, OTHER, END = 0, 1, 2, 3, 4
# The code points with the White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE_SPACE] = SPACE
    return out


@dataclass
class Words:
    """Pre-tokens of a list of texts: an index into distinct words, -1 for the special token."""

    index: np.ndarray
    per_text: np.ndarray
    flat: np.ndarray
    offsets: np.ndarray


def _pieces(texts: list[str], special: str | None) -> tuple[list[str], np.ndarray]:
    """Texts cut at the special token; how many pieces each text has."""
    if special is None or not any(special in x for x in texts):
        return texts, np.ones(len(texts), np.int64)
    cut = [x.split(special) for x in texts]
    return [y for x in cut for y in x], np.array([len(x) for x in cut], np.int64)


def _starts(code: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Mask of the characters at which a pre-token (or an end mark) starts."""
    n = len(code)
    first = np.ones(n, bool)
    first[1:] = kind[1:] != kind[:-1]
    after_blank = np.zeros(n, bool)
    after_blank[1:] = code[:-1] == 32
    solid = (kind != SPACE) & (kind != END)
    start = first & ~(solid & after_blank)
    start[:-1] |= (kind[:-1] == SPACE) & solid[1:]
    quote = np.flatnonzero((code[:-3] == 39) & first[:-3] & ~after_blank[:-3] & (kind[1:-2] == LETTER))
    one, two = code[quote + 1], code[quote + 2]
    short = np.isin(one, [ord(x) for x in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    start[quote[short | long] + 1] = False
    start[quote[short] + 2] = True
    start[quote[long] + 3] = True
    start |= kind == END
    return start


def split_words(texts: list[str], special: str | None = None, chunk: int = 1 << 21) -> Words:
    """Pre-tokens of all texts, each distinct word kept once.

    Words of up to 16 bytes are compared as two integers, longer ones as bytes.
    """
    pieces, per = _pieces(texts, special)
    w0s, w1s, lens, counts, longs, long_at, seen = [], [], [], [], {}, [], 0
    k = 0
    while k < len(pieces):
        j, size = k, 0
        while j < len(pieces) and (j == k or size + len(pieces[j]) <= chunk):
            size += len(pieces[j]) + 1
            j += 1
        joined = "\0".join(pieces[k:j]) + "\0\0\0\0"
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = classes()[code]
        ends = np.cumsum([len(x) + 1 for x in pieces[k:j]]) - 1
        kind[ends] = END
        kind[ends[-1] :] = END
        at = np.flatnonzero(_starts(code, kind))
        real = kind[at[:-1]] != END
        begin, stop = at[:-1][real], at[1:][real]
        counts.append(np.diff(np.searchsorted(begin, ends), prepend=0))
        raw = joined.encode("utf-8", "surrogatepass")
        data = np.frombuffer(raw + bytes(16), np.uint8)
        if len(raw) != len(code):
            place = np.flatnonzero((data[: len(raw)] & 0xC0) != 0x80).astype(np.int64)
            begin, stop = place[begin], place[stop]
        length = stop - begin
        wide = np.lib.stride_tricks.as_strided(data.view(), (len(data) - 7, 8), (1, 1))
        w0 = np.ascontiguousarray(wide[begin]).view(np.uint64).ravel() & _MASK[np.minimum(length, 8)]
        w1 = np.ascontiguousarray(wide[begin + 8]).view(np.uint64).ravel() & _MASK[np.clip(length - 8, 0, 8)]
        far = np.flatnonzero(length > 16)
        for x in far.tolist():
            word = raw[begin[x] : stop[x]]
            w0[x] = longs.setdefault(word, len(longs))
        w1[far] = 0
        length[far] = 17
        long_at.append(far + seen)
        seen += len(begin)
        w0s.append(w0)
        w1s.append(w1)
        lens.append(length.astype(np.uint8))
        k = j
    if not pieces:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8), np.zeros(1, np.int64))
    w0, w1, length = np.concatenate(w0s), np.concatenate(w1s), np.concatenate(lens)
    mixed = (w0 ^ (w0 >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) ^ (w1 + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xC2B2AE3D27D4EB4F)
    index, kinds = pd.factorize(mixed)
    shown = np.zeros(len(kinds), np.int64)
    shown[index[::-1]] = np.arange(len(index) - 1, -1, -1)
    lead = shown[index]
    if not ((w0[lead] == w0).all() and (w1[lead] == w1).all() and (length[lead] == length).all()):  # two words share a mix
        _, shown, index = np.unique(np.rec.fromarrays([w0, w1, length]), return_index=True, return_inverse=True)
    sizes = length[shown].astype(np.int64)
    names = list(longs)
    is_long = np.flatnonzero(sizes == 17)
    which = w0[shown[is_long]].astype(np.int64)
    sizes[is_long] = [len(names[x]) for x in which.tolist()]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    flat = np.zeros(offsets[-1], np.uint8)
    small = np.flatnonzero(length[shown] <= 16)
    block = np.stack([w0[shown[small]], w1[shown[small]]], 1).view(np.uint8).reshape(-1, 16)
    inside = np.arange(16)[None, :] < sizes[small][:, None]
    flat[(offsets[small][:, None] + np.arange(16)[None, :])[inside]] = block[inside]
    for x, w in zip(is_long.tolist(), which.tolist(), strict=True):
        flat[offsets[x] : offsets[x + 1]] = np.frombuffer(names[w], np.uint8)
    counted = np.concatenate(counts)
    if len(pieces) == len(texts):
        return Words(index, counted, flat, offsets)
    text_of = np.repeat(np.arange(len(texts)), per)
    last = np.cumsum(per) - 1
    inner = np.ones(len(pieces), bool)
    inner[last] = False
    index = np.insert(index, np.cumsum(counted)[inner], -1)
    return Words(index, np.bincount(text_of, weights=counted + inner, minlength=len(texts)).astype(np.int64), flat, offsets)


def gather(flat: np.ndarray, offsets: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows `pick` of a ragged array, end to end, and their lengths."""
    size = (offsets[1:] - offsets[:-1])[pick]
    total = int(size.sum())
    begin = np.cumsum(size) - size
    at = np.arange(total) + np.repeat(offsets[:-1][pick] - begin, size)
    return flat[at], size
