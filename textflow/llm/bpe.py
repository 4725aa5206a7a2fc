"""Byte-level BPE: a lazily determinised transducer, and streaming decoding.

Encoding.  Two neighbouring tokens are *compatible* when encoding their
bytes together gives exactly these two; a token sequence is the BPE encoding
of its bytes iff all neighbours are compatible.  So encoding is a
nondeterministic transducer that walks the vocabulary trie and may cut after
any token compatible with the one before it.  Its subset construction is
made lazily: a state is the set of live hypotheses (tokens not yet emitted,
trie node); tokens on which all hypotheses agree are emitted at once, so
the lookahead is bounded by the longest token.  States and transitions are
built when first needed and kept in a bounded table; the states met first, near
the root, are the ones that stay.

Decoding.  Bytes of the ids run through an incremental UTF-8 state machine;
its effect is kept per (state, id), and an id that is whole characters in
itself costs one lookup.

Pre-tokens come from the given pattern; each is encoded separately.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textflow.llm.memo import ChunkMemo
from textflow.llm.words import chunk_runs

_INF = 1 << 60
ROOT = 0
# bounds of a worker's tables; a full table is kept as it is, and what it lacks
# is worked out each time, which costs time and changes no result
MAX_STATES, MAX_PAIRS = 60_000, 250_000


class Merges:
    """Ranks, and how each token is made of two smaller ones."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for b, i in ranks.items():
            self.bytes_of[i] = b
        # the two tokens that each token is merged from; -1: not known yet
        self._halves = array("i", [-1]) * (2 * len(self.bytes_of))
        self._fits: dict[int, bool] = {}

    def merge(self, piece: bytes, stop: int = 1) -> list[bytes]:
        """Plain merging by rank until ``stop`` parts are left."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > stop:
            best, at = _INF, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1], _INF)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, token: int, right: bool) -> list[int]:
        """Tokens on that edge of the token's merge tree, from the outermost
        byte inwards; each is absorbed by the merge that makes the next."""
        at, found, halves = token, [], self._halves
        while True:
            found.append(at)
            body = self.bytes_of[at]
            if len(body) == 1:
                break
            if halves[2 * at] < 0:
                parts = self.merge(body, 2)
                halves[2 * at] = self.ranks[parts[0]]
                halves[2 * at + 1] = self.ranks[parts[-1]]
            at = halves[2 * at + 1 if right else 2 * at]
        found.reverse()
        return found

    def compatible(self, left: int, right: int) -> bool:
        """No merge across the border comes before those inside."""
        key = left << 20 | right
        known = self._fits.get(key)
        if known is not None:
            return known
        a, b = self._edge(left, True), self._edge(right, False)
        text, ranks = self.bytes_of, self.ranks
        i = j = 0
        last_i, last_j = len(a) - 1, len(b) - 1
        while True:
            # a token's id is its rank: the merge that makes it
            up_x = a[i + 1] if i < last_i else _INF
            up_y = b[j + 1] if j < last_j else _INF
            across = ranks.get(text[a[i]] + text[b[j]], _INF)
            # of equal ranks the leftmost pair is merged first
            if across < up_x and across <= up_y and across < _INF:
                fits = False
                break
            if up_x == up_y == _INF:
                fits = True
                break
            if up_x <= up_y:
                i += 1
            else:
                j += 1
        if len(self._fits) < MAX_PAIRS:
            self._fits[key] = fits
        return fits


class Transducer:
    """Lazily determinised encoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], limit: int = MAX_STATES) -> None:
        self.merges = Merges(ranks)
        self.limit = limit
        self._child: list[dict[int, int]] = [{}]
        self._token: list[int] = [-1]
        for piece, i in ranks.items():
            node = ROOT
            for byte in piece:
                nxt = self._child[node].get(byte)
                if nxt is None:
                    nxt = self._child[node][byte] = len(self._child)
                    self._child.append({})
                    self._token.append(-1)
                node = nxt
            self._token[node] = i
        # a state: (last emitted token or -1, ((pending tokens, node), ...))
        first = (-1, (((), ROOT),))
        self._states = [first]
        self._number = {first: 0}
        # state << 8 | byte -> (next state, tokens emitted)
        self._next: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _step(self, state, byte: int):
        last, hypotheses = state
        child, token = self._child, self._token
        compatible = self.merges.compatible
        live = []
        for pending, node in hypotheses:
            nxt = child[node].get(byte)
            if nxt is None:
                continue
            if child[nxt]:
                live.append((pending, nxt))
            t = token[nxt]
            if t >= 0:
                before = pending[-1] if pending else last
                if before < 0 or compatible(before, t):
                    live.append((pending + (t,), ROOT))
        first = live[0][0]
        if len(live) == 1:
            out, live = first, [((), live[0][1])]
        else:
            n = 0
            for n, t in enumerate(first):   # noqa: B007
                for p, _ in live:
                    if len(p) <= n or p[n] != t:
                        break
                else:
                    continue
                break
            else:
                n = len(first)
            out = first[:n]
            if n:
                live = [(p[n:], node) for p, node in live]
        if out:
            last = out[-1]
        for p, _ in live:
            if not p:
                break
        else:
            last = -1           # no longer looked at
        live.sort()
        return (last, tuple(live)), out

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token."""
        whole = self.merges.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        s, state, follow = 0, None, self._next
        for byte in piece:
            if s >= 0:
                go = follow.get(s << 8 | byte)
                if go is not None:
                    s = go[0]
                    if go[1]:
                        out += go[1]
                    continue
                state = self._states[s]
            state, emitted = self._step(state, byte)
            out += emitted
            to = self._number.get(state, -1)
            if to < 0 and len(self._states) < self.limit:
                to = self._number[state] = len(self._states)
                self._states.append(state)
            if s >= 0 and to >= 0:
                follow[s << 8 | byte] = to, emitted
            s = to              # -1: a state that found no room
        for pending, node in (self._states[s] if s >= 0 else state)[1]:
            if node == ROOT:
                out += pending
        return out


class Utf8Machine:
    """Incremental UTF-8 decoding; a state is the bytes of a character begun
    so far (at most three).  Ill-formed sequences become U+FFFD, one for
    each maximal part of a character."""

    def __init__(self, bytes_of: list[bytes]) -> None:
        self._bytes_of = bytes_of
        self._go: dict[tuple[bytes, int], tuple[bytes, str]] = {}
        self.alone: list[str | None] = []
        for b in bytes_of:
            try:
                self.alone.append(b.decode("utf-8"))
            except UnicodeDecodeError:
                self.alone.append(None)
        self.whole = np.array([a is not None for a in self.alone] or [True])

    @staticmethod
    def _room(first: int) -> tuple[int, int, int]:
        """(length, smallest and largest second byte) by the first byte."""
        if 0xC2 <= first <= 0xDF:
            return 2, 0x80, 0xBF
        if 0xE0 <= first <= 0xEF:
            return 3, 0xA0 if first == 0xE0 else 0x80, (
                0x9F if first == 0xED else 0xBF)
        if 0xF0 <= first <= 0xF4:
            return 4, 0x90 if first == 0xF0 else 0x80, (
                0x8F if first == 0xF4 else 0xBF)
        return 0, 0, 0

    def feed(self, state: bytes, data: bytes) -> tuple[bytes, str]:
        out: list[str] = []
        for byte in data:
            if state:
                n, lo, hi = self._room(state[0])
                if len(state) > 1:
                    lo, hi = 0x80, 0xBF
                if lo <= byte <= hi:
                    state += bytes([byte])
                    if len(state) == n:
                        out.append(state.decode("utf-8"))
                        state = b""
                    continue
                out.append("�")
                state = b""
            if byte < 0x80:
                out.append(chr(byte))
            elif self._room(byte)[0]:
                state = bytes([byte])
            else:
                out.append("�")
        return state, "".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """Text of one document's ids."""
        if self.whole[ids].all():
            return "".join(map(self.alone.__getitem__, ids.tolist()))
        state, out = b"", []
        for i in ids.tolist():
            if not state and self.alone[i] is not None:
                out.append(self.alone[i])
                continue
            go = self._go.get((state, i))
            if go is None:
                go = self._go[state, i] = self.feed(state, self._bytes_of[i])
            state, s = go
            out.append(s)
        return "".join(out) + ("�" if state else "")


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b)
                for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str):
    fst = Transducer(load_ranks(path))
    split = regex.compile(pattern)

    def encode(chunks: list[bytes]) -> list[list[int]]:
        out = []
        for c in chunks:
            ids: list[int] = []
            for piece in split.findall(c.decode("utf-8")):
                ids += fst.encode(piece.encode("utf-8"))
            out.append(ids)
        return out

    bytes_of = fst.merges.bytes_of
    size = np.array([len(b) for b in bytes_of], np.int64)
    return (ChunkMemo(encode), Utf8Machine(bytes_of), size,
            [str(i) for i in range(len(bytes_of))])


FIELDS = {
    "ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType(),
    "n_tokens": T.LongType(), "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def _pass(path: str, pattern: str, fields: list[str], like: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, machine, size, decimal = _codec(path, pattern)
        sha = hashlib.sha256
        for b in batches:
            keys = b.column(0)
            for r in chunk_runs(b.column(1), False, True):
                ids, off = memo.ids(r)
                cols: dict[str, list] = {f: [] for f in fields}
                for i in range(r.rows):
                    mine = ids[off[i]:off[i + 1]]
                    if "ids" in cols:
                        cols["ids"].append(mine)
                    if "n_tokens" in cols:
                        cols["n_tokens"].append(len(mine))
                    if "ids_sha256" in cols:
                        cols["ids_sha256"].append(sha(" ".join(
                            map(decimal.__getitem__, mine.tolist()))
                            .encode()).hexdigest())
                    if "decoded" in cols or "decoded_sha256" in cols:
                        text = machine.decode(mine)
                        if "decoded" in cols:
                            cols["decoded"].append(text)
                        if "decoded_sha256" in cols:
                            cols["decoded_sha256"].append(
                                sha(text.encode("utf-8")).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(r.first, r.rows),
                     *[pa.array(cols[f], like.field(f).type)
                       for f in fields]], schema=like)

    return run


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str,
                  fields: list[str] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``id`` and the chosen ``FIELDS`` of every row: token ids, the text
    decoded from them, and digests of both.

    Null text counts as empty (no ids); repeated rows are encoded one by
    one; other columns of ``docs`` are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = list(FIELDS if fields is None else fields)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           *[T.StructField(f, FIELDS[f]) for f in fields]])
    return docs.select(id_col, text_col).mapInArrow(
        _pass(ranks_path, pattern, fields, to_arrow_schema(schema)), schema)


def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from textflow.llm.stage import documents
    return encode_decode(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        ["n_tokens", "ids_sha256", "decoded_sha256"]
    ).withColumnRenamed("id", "doc_id")
