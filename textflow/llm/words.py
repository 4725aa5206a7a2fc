"""Vectorised splitting of Arrow string batches into hashed byte runs.

All operators of this package that look at words do it on the UTF-8 buffer
of an Arrow string array with numpy: one table lookup per byte gives its
class, class changes give run boundaries, and a polynomial prefix sum modulo
2**64 gives a 64-bit hash per run (two runs share a hash iff they are equal,
up to a collision chance of about n**2 / 2**65 for n distinct runs).

Batches are cut into pieces of a few MB, never inside a row, so the numpy
temporaries stay small whatever the batch size is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

_R = np.uint64(0x9E3779B97F4A7C15)          # odd, so invertible mod 2**64
_R_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, PIECE_BYTES + (PIECE_BYTES >> 1))
        p = np.full(size, _R, np.uint64)
        q = np.full(size, _R_INV, np.uint64)
        p[0] = q[0] = 1
        p, q = np.cumprod(p), np.cumprod(q)
        if size > 8 * PIECE_BYTES:      # one very long row: do not keep
            return p, q
        _POW, _INV = p, q
    return _POW, _INV


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hash -> float64 in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * (2.0 ** -53)


@dataclass
class Runs:
    """Runs of one piece: byte ranges, hashes, and row -> run offsets."""

    first: int              # index of the piece's first row in the batch
    buf: np.ndarray         # class-mapped bytes (as hashed)
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    ptr: np.ndarray         # len(rows) + 1 offsets into start/end/hash
    off: np.ndarray         # len(rows) + 1 byte offsets of the rows
    raw: np.ndarray | None = None       # the bytes themselves (word_runs)

    @property
    def rows(self) -> int:
        return len(self.ptr) - 1

    def prefix(self) -> np.ndarray:
        """prefix[i] = polynomial sum of buf[:i]."""
        return self._prefix

    def text(self, i: int) -> bytes:
        return self.buf[self.start[i]:self.end[i]].tobytes()


def pieces(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of a string array; null = empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    arr = pc.fill_null(texts, "").cast(pa.large_string())
    off = np.frombuffer(arr.buffers()[1], np.int64)[
        arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2], np.uint8) \
        if arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    i, n = 0, len(arr)
    while i < n:
        j = int(np.searchsorted(off, off[i] + PIECE_BYTES, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def hash_runs(first: int, mapped: np.ndarray, start: np.ndarray,
              end: np.ndarray, off: np.ndarray) -> Runs:
    pw, inv = _powers(len(mapped) + 1)
    pre = np.zeros(len(mapped) + 1, np.uint64)
    np.cumsum(mapped.astype(np.uint64) * pw[:len(mapped)], out=pre[1:])
    h = (pre[end] - pre[start]) * inv[start]
    h = mix(h ^ ((end - start).astype(np.uint64) << np.uint64(56)))
    r = Runs(first, mapped, start, end, h, np.searchsorted(start, off), off)
    r._prefix = pre
    return r


def _table(word: str) -> np.ndarray:
    """byte -> lower-cased byte inside a word, 0 outside."""
    t = np.zeros(256, np.uint8)
    for b in range(256):
        c = b + 32 if 65 <= b <= 90 else b
        digit, letter = 48 <= c <= 57, 97 <= c <= 122 or c >= 128
        if letter or (digit and word == "alnum"):
            t[b] = c
    return t


#: A-Z lower-cased; words are runs of 0-9, a-z and every byte >= 0x80
WORDS = _table("alnum")
#: the same without digits
LETTERS = _table("letters")


def word_runs(texts: pa.Array, table: np.ndarray = WORDS) -> Iterator[Runs]:
    """Maximal runs of word bytes of every row, piece by piece."""
    for first, raw, off in pieces(texts):
        m = table[raw]
        n = len(m)
        w = np.zeros(n + 2, bool)
        w[1:-1] = m != 0
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        start = np.flatnonzero(w[1:-1] & (~w[:-2] | edge[:n]))
        end = np.flatnonzero(w[1:-1] & (~w[2:] | edge[1:])) + 1
        r = hash_runs(first, m, start, end, off)
        r.raw = raw
        yield r


# byte classes for chunking: 0 white space, 1 letter, 2 digit, 3 other ASCII,
# 4 apostrophe, 5 part of a non-ASCII character
_CLASS = np.full(256, 3, np.uint8)
for _b in range(256):
    if _b in (9, 10, 11, 12, 13, 32):
        _CLASS[_b] = 0
    elif chr(_b).isascii() and chr(_b).isalpha():
        _CLASS[_b] = 1
    elif 48 <= _b <= 57:
        _CLASS[_b] = 2
    elif _b == 39:
        _CLASS[_b] = 4
    elif _b >= 128:
        _CLASS[_b] = 5


def _breaks(digit_digit: bool, space_joins: bool) -> np.ndarray:
    """36 flags (previous class * 6 + class): is a chunk boundary certain?

    Certain only between two ASCII bytes of different kind, and never after
    an apostrophe: a contraction takes the letters that follow it, and what
    stands next to a non-ASCII character depends on that character (it may be
    white space itself).
    """
    t = np.zeros((6, 6), bool)
    for a, b in ((1, 2), (1, 3), (1, 4), (2, 1), (2, 3), (2, 4), (3, 1),
                 (3, 2)):
        t[a, b] = True
    t[2, 2] = digit_digit
    t[1:, 0] = True
    t[5, 0] = t[0, 1:] = not space_joins
    return t.ravel()


def chunk_runs(texts: pa.Array, lower: bool, keep_space: bool
               ) -> Iterator[Runs]:
    """Chunks whose ends are certain pre-token boundaries.

    ``keep_space=False``: white space only separates, every ASCII digit is a
    chunk (word-end BPE).  ``keep_space=True``: a chunk is a run of ASCII
    white space with the run that follows it (byte-level BPE).
    """
    brk = _breaks(not keep_space, keep_space)
    for first, raw, off in pieces(texts):
        n = len(raw)
        m = np.where((raw >= 65) & (raw <= 90), raw | 32, raw).astype(
            np.uint8) if lower else raw
        c = _CLASS[raw]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        new = edge[:n].copy()
        if n:
            new[1:] |= brk[c[:-1] * np.uint8(6) + c[1:]]
            # U+00C0 to U+00FF (lead byte C3) is no white space
            new[2:] |= (raw[:-2] == 0xC3) & (c[1:-1] == 5) & (c[2:] == 0)
        if keep_space:
            start = np.flatnonzero(new)
            end = np.append(start[1:], n) if n else start
        else:
            live = c != 0
            stop = edge[1:].copy()
            if n:
                stop[:-1] |= new[1:] | ~live[1:]
            start = np.flatnonzero(live & new)
            end = np.flatnonzero(live & stop) + 1
        yield hash_runs(first, m, start, end, off)


def spread(counts: np.ndarray) -> np.ndarray:
    """[2, 0, 3] -> [0, 0, 2, 2, 2]"""
    return np.repeat(np.arange(len(counts)), counts)


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenated ``arange(start[i], start[i] + count[i])``."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(count) - count
    return np.arange(total) + np.repeat(start - first, count)
