"""Pairs of close words by symmetric deletion, inside one task.

Two words within ``d`` edits of each other share a string that is left after
up to ``d`` deletions from their first ``PREFIX`` letters.  These keys are 64-bit
hashes worked out in numpy from a block of dictionary words and a block of
other words, and never leave the task: a key that two words share by chance
only costs a check, as every pair is verified on the whole words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PREFIX = 12
#: words whose keys are made at once, and pairs that are verified at once
SLICE, PAIRS = 4096, 1 << 20
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C55), np.uint64(0xD6E8FEB86659FD93)
#: the bits of a key that a table of the dictionary's keys is asked for first
_SEEN_BITS = 24


class Words:
    """The code points of an array of words, one after the other."""

    def __init__(self, words: pa.Array | pa.ChunkedArray) -> None:
        texts = words.to_pylist()
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.size)])[:-1]
        self.codes = np.frombuffer("".join(texts).encode(
            "utf-32-le", "surrogatepass"), np.uint32)

    def matrix(self, rows: np.ndarray, width: int) -> np.ndarray:
        """The first ``width`` code points of words; 0 behind their ends."""
        at = self.first[rows][:, None] + np.arange(width)
        out = self.codes[np.minimum(at, max(len(self.codes) - 1, 0))] \
            if len(self.codes) else np.zeros(at.shape, np.uint32)
        out[np.arange(width) >= self.size[rows][:, None]] = 0
        return out


def _keys(words: Words, rows: np.ndarray, distance: int
          ) -> tuple[np.ndarray, np.ndarray]:
    """(keys, rows): every key of the given words."""
    keys, owners = [], []
    length = np.minimum(words.size[rows], PREFIX)
    for n in np.unique(length):
        own = rows[length == n]
        codes = (words.matrix(own, int(n)).astype(np.uint64)
                 + np.uint64(1)) * _MIX
        columns = [np.ascontiguousarray(codes[:, i]) for i in range(n)]
        for r in range(min(distance, int(n)) + 1):
            for gone in combinations(range(n), r):
                h = np.full(len(own), n - r, np.uint64)
                for i in range(n):
                    if i not in gone:
                        h = h * _BASE + columns[i]
                keys.append((h ^ (h >> np.uint64(29))) * _MIX)
                owners.append(own)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return (np.concatenate(keys), np.concatenate(owners)) if keys else none


def distances(a: Words, i: np.ndarray, b: Words, j: np.ndarray, most: int
              ) -> np.ndarray:
    """Levenshtein distances of the pairs, ``most + 1`` for larger ones."""
    out = np.full(len(i), most + 1, np.int64)
    gap = b.size[j] - a.size[i]
    longest = np.maximum(a.size[i], b.size[j])
    classes = np.ceil(np.log2(np.maximum(longest, 8))).astype(int)
    classes[np.abs(gap) > most] = -1
    for c in np.unique(classes[classes >= 0]):
        width = 1 << int(c)
        of_class = np.flatnonzero(classes == c)
        step = max(1, (1 << 22) // width)
        for at in range(0, len(of_class), step):
            x = of_class[at:at + step]
            out[x] = _banded(a.matrix(i[x], width), a.size[i[x]],
                             b.matrix(j[x], width), gap[x], most)
    return out


def _banded(a: np.ndarray, size: np.ndarray, b: np.ndarray, gap: np.ndarray,
            most: int) -> np.ndarray:
    """The diagonals -most .. most of the table of edits, row by row."""
    n, width = a.shape
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    over = np.full(n, most + 1, np.int64)
    row = [over if k < 0 else np.full(n, k, np.int64)
           for k in range(-most, most + 1)]
    out = np.where(size == 0, np.choose(np.clip(gap + most, 0, 2 * most), row),
                   over)
    for i in range(1, int(size.max(initial=0)) + 1):
        new: list[np.ndarray] = []
        for k in range(-most, most + 1):
            j = i + k
            if j < 0 or j > width:
                new.append(over)
                continue
            if j == 0:
                new.append(np.full(n, i, np.int64))
                continue
            cell = row[k + most] + (a[i - 1] != b[j - 1])
            if k < most:
                cell = np.minimum(cell, row[k + most + 1] + 1)
            if k > -most:
                cell = np.minimum(cell, new[-1] + 1)
            new.append(np.minimum(cell, most + 1))
        row = new
        ends = np.flatnonzero(size == i)
        if len(ends):
            out[ends] = np.stack(row)[gap[ends] + most, ends]
    return out


def _meetings(keys: np.ndarray, rows: np.ndarray, dic_keys: np.ndarray,
              dic_rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, dictionary rows) that share a key, in bounded pieces."""
    lo = np.searchsorted(dic_keys, keys, "left")
    n = np.searchsorted(dic_keys, keys, "right") - lo
    lo, n, rows = lo[n > 0], n[n > 0], rows[n > 0]
    upto = np.cumsum(n)
    done = 0
    while done < len(n):
        start = upto[done - 1] if done else 0
        end = max(done + 1, int(np.searchsorted(upto, start + PAIRS, "right")))
        some = n[done:end]
        first = np.repeat(np.cumsum(some) - some, some)
        yield (np.repeat(rows[done:end], some), dic_rows[
            np.repeat(lo[done:end], some) + np.arange(some.sum()) - first])
        done = end


def best_matches(words: Words, dic: Words, rank: np.ndarray, distance: int
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows of words, rows of dictionary words, distances): of every word
    that has a dictionary word within ``distance`` the closest one, of equally
    close ones that of the lowest ``rank``."""
    made = [_keys(dic, np.arange(at, min(at + SLICE, len(dic.size))), distance)
            for at in range(0, len(dic.size), SLICE)]
    if not made:
        return (np.zeros(0, np.int64),) * 3
    dic_keys = np.concatenate([k for k, _ in made])
    order = np.argsort(dic_keys)
    dic_keys = dic_keys[order]
    dic_rows = np.concatenate([r for _, r in made])[order]
    del made, order
    shift = np.uint64(64 - _SEEN_BITS)
    seen = np.zeros(1 << _SEEN_BITS, bool)
    seen[dic_keys >> shift] = True
    n, none = len(dic.size), np.iinfo(np.int64).max
    best = np.full(len(words.size), none, np.int64)
    by_rank = np.empty(n, np.int64)
    by_rank[rank] = np.arange(n)
    for at in range(0, len(words.size), SLICE):
        keys, rows = _keys(words, np.arange(at, min(at + SLICE,
                                                    len(words.size))), distance)
        hit = seen[keys >> shift]
        for i, j in _meetings(keys[hit], rows[hit], dic_keys, dic_rows):
            near = np.abs(words.size[i] - dic.size[j]) <= distance
            pair = np.unique(i[near] * n + j[near])
            i, j = pair // n, pair % n
            d = distances(words, i, dic, j, distance)
            close = d <= distance
            np.minimum.at(best, i[close], d[close] * n + rank[j[close]])
    found = np.flatnonzero(best != none)
    return found, by_rank[best[found] % n], best[found] // n


def block_matches(distance: int, group: list[str]) -> Callable:
    """For ``cogroup().applyInArrow``: of a block of words (group..., word) and
    a block of the dictionary (_cand, _cc) the best match of every word, by
    distance, then count, then alphabet."""
    def matches(words: pa.Table, dic: pa.Table) -> pa.Table:
        order = pc.sort_indices(dic, [("_cc", "descending"),
                                      ("_cand", "ascending")]).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        i, j, d = best_matches(Words(words.column("word")),
                               Words(dic.column("_cand")), rank, distance)
        own, other = words.take(pa.array(i)), dic.take(pa.array(j))
        return pa.table({**{c: own.column(c) for c in (*group, "word")},
                         "cand": other.column("_cand"),
                         "cc": other.column("_cc"),
                         "dist": pa.array(d, pa.int32())})
    return matches
