"""Words and their hashes, for whole Arrow text columns at once.

A word is a match of ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased.  A word
is known by a 64-bit hash of its UTF-8 bytes; sets and counts are kept by hash
(two of a thousand million different words share one with a chance of 3 %).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are taken through numpy at once; a longer text goes alone.
CHUNK_BYTES = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64


def mix64(z: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    z = z ^ (z >> _U(30))
    z = z * _U(0xBF58476D1CE4E5B9)
    z = z ^ (z >> _U(27))
    z = z * _U(0x94D049BB133111EB)
    return z ^ (z >> _U(31))


@dataclass
class Words:
    """Words of consecutive documents: ``first[d]:first[d + 1]`` are those of document d."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    buf: np.ndarray
    off: np.ndarray

    def of(self, d: int) -> slice:
        return slice(int(self.first[d]), int(self.first[d + 1]))


def buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64, len(col) + 1 + col.offset)[col.offset :] if off else np.zeros(len(col) + 1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf, off


def chunks(off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``limit`` bytes, or of one document."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def words(buf: np.ndarray, off: np.ndarray, lower: bool = True) -> Words:
    """The words of the documents between ``off[0]`` and ``off[-1]``; a long range is taken piece by piece."""
    lo, hi = int(off[0]), int(off[-1])
    if hi - lo <= 2 * CHUNK_BYTES:
        return _words(buf, off, lower)
    pieces, at = [], lo
    while at < hi:
        to = min(hi, at + CHUNK_BYTES)
        if to < hi:  # up to the last space, or, where there is none, the next one
            space = np.flatnonzero(SPACE[buf[at:to]])
            while not len(space) and to < hi:
                more = min(hi, to + CHUNK_BYTES)
                space = np.flatnonzero(SPACE[buf[to:more]]) + (to - at)
                to = more
            to = at + int(space[-1]) + 1 if len(space) else hi
        inner = off[(off > at) & (off < to)]
        w = _words(buf, np.concatenate([[at], inner, [to]]), lower)
        pieces.append((w.hash, w.start + (at - lo), w.end + (at - lo), w.buf))
        at = to
    hashes, start, end, b = (np.concatenate(x) for x in zip(*pieces, strict=True))
    return Words(hashes, start, end, np.searchsorted(start, off - lo), b, off - lo)


def _words(buf: np.ndarray, off: np.ndarray, lower: bool) -> Words:
    base = int(off[0])
    b, off = buf[base : int(off[-1])], off - base
    n = len(b)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(off), np.int64), b, off)
    if lower:
        b = LOWER[b]
    word = ~SPACE[b]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | edge[1:n]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, off)
    if not len(start):
        return Words(np.zeros(0, np.uint64), start, end, first, b, off)
    s0 = int(start[0])
    spans = np.diff(np.append(start, n))
    pos = np.arange(s0, n) - np.repeat(start, spans)
    power = np.cumprod(np.concatenate([[_U(1)], np.full(int(spans.max()), _BASE)]), dtype=np.uint64)
    value = (b[s0:].astype(np.uint64) + _U(1)) * word[s0:]
    value *= power[pos]
    total = np.add.reduceat(value, start - s0)
    return Words(mix64(total ^ ((end - start).astype(np.uint64) << _U(48))), start, end, first, b, off)


def text_chunks(col: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """(first, past last, words) for ranges of the rows of a text column."""
    buf, off = buffers(col)
    for lo, hi in chunks(off):
        yield lo, hi, words(buf, off[lo : hi + 1])


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and where each document's begin.

    A document of fewer words has its whole sequence as the one shingle, and one
    without words has none.  A run's hash is of its words in order; runs of
    fewer words are told apart by their length.
    """
    counts = np.diff(w.first)
    n = len(w.hash)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(w.first), np.int64)
    pad = np.concatenate([w.hash, np.zeros(size, np.uint64)])
    run = np.zeros(n, np.uint64)
    for k in range(size):
        run = run * _BASE + pad[k : k + n]
    doc = np.repeat(np.arange(len(counts)), counts)
    left = w.first[1:][doc] - np.arange(n)
    keep = left >= size
    short = np.flatnonzero((counts > 0) & (counts < size))
    for d in short:
        at, h = int(w.first[d]), np.uint64(0)
        for x in w.hash[w.of(d)]:
            h = np.uint64((int(h) * int(_BASE) + int(x) + 1) & 0xFFFFFFFFFFFFFFFF)
        run[at] = h ^ _U(int(counts[d]))
        keep[at] = True
    sizes = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    return mix64(run[keep]), np.concatenate([[0], np.cumsum(sizes)])


class Index:
    """Places of 64-bit hashes in a sorted array of distinct ones, by their leading bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(1, min(24, int(len(keys)).bit_length() + 1))
        self.shift = _U(64 - bits)
        lead = (keys >> self.shift).astype(np.int64)
        self.begin = np.searchsorted(lead, np.arange((1 << bits) + 1)).astype(np.int32)
        self.most = int(np.diff(self.begin).max()) if len(keys) else 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        out = np.full(len(hashes), -1, np.int32)
        if not len(self.keys) or not len(hashes):
            return out
        lead = (hashes >> self.shift).astype(np.int64)
        at, end = self.begin[lead], self.begin[lead + 1]
        rest = np.flatnonzero(at < end)
        for k in range(self.most):
            place = at[rest] + k
            hit = self.keys[place] == hashes[rest]
            out[rest[hit]] = place[hit]
            rest = rest[~hit]
            rest = rest[at[rest] + k + 1 < end[rest]]
            if not len(rest):
                break
        return out
