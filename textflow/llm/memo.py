"""Per-worker memo of chunk encodings.

Text repeats its words, so a worker encodes every distinct chunk once and
assembles the ids of whole batches with numpy gathers.  The memo holds at
most ``limit`` chunks and starts anew beyond that: results never depend on
what is in it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from textflow.llm.words import Runs, ranges

LIMIT = 700_000


class ChunkMemo:
    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]],
                 limit: int = LIMIT) -> None:
        self._encode, self._limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self._key = np.zeros(0, np.uint64)
        self._at = np.zeros(0, np.int64)
        self._len = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)
        self._used = 0

    def _learn(self, keys: np.ndarray, chunks: list[bytes]) -> None:
        """``keys``: sorted, none of them known."""
        if len(self._key) + len(keys) > self._limit and len(self._key):
            raise OverflowError
        found = self._encode(chunks)
        size = np.fromiter(map(len, found), np.int64, len(found))
        new = np.fromiter((i for f in found for i in f), np.uint32,
                          int(size.sum()))
        if self._used + len(new) > len(self._ids):
            grown = np.zeros(2 * (self._used + len(new)), np.uint32)
            grown[:self._used] = self._ids[:self._used]
            self._ids = grown
        self._ids[self._used:self._used + len(new)] = new
        at = self._used + np.cumsum(size) - size
        self._used += len(new)
        where = np.searchsorted(self._key, keys)
        self._key = np.insert(self._key, where, keys)
        self._at = np.insert(self._at, where, at)
        self._len = np.insert(self._len, where, size)

    def _find(self, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
        """(memo entry of every distinct chunk, distinct chunk per run)."""
        uniq, first, inv = np.unique(runs.hash, return_index=True,
                                     return_inverse=True)

        def entries():
            pos = np.searchsorted(self._key, uniq)
            pos[pos == len(self._key)] = 0
            known = self._key[pos] == uniq if len(self._key) else np.zeros(
                len(uniq), bool)
            return pos, known

        pos, known = entries()
        if not known.all():
            for attempt in (0, 1):
                new = np.flatnonzero(~known)
                try:
                    self._learn(uniq[new], [runs.text(int(first[i]))
                                            for i in new])
                    break
                except OverflowError:
                    self._clear()
                    pos, known = entries()
            pos, known = entries()
        return pos, inv

    def counts(self, runs: Runs) -> np.ndarray:
        """Ids of every row."""
        pos, inv = self._find(runs)
        total = np.zeros(len(inv) + 1, np.int64)
        np.cumsum(self._len[pos][inv], out=total[1:])
        return np.diff(total[runs.ptr])

    def ids(self, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the whole piece, row offsets into them)."""
        pos, inv = self._find(runs)
        run = pos[inv]
        size = self._len[run]
        total = np.zeros(len(inv) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        return self._ids[ranges(self._at[run], size)], total[runs.ptr]
