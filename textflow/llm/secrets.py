"""Secret scanning with inferred grammars of credentials.

1. One pass over all texts finds the values of the base patterns and counts
   the characters of the credential alphabet.  The result is a small table.
2. The values of the base spans are labelled credentials (the label is the
   pattern that found them).  Of each kind, at most ``SAMPLE`` different
   values with the smallest hashes are used to infer a grammar: their prefix
   tree, written in character classes, is folded into a probabilistic
   automaton by merging states whose outgoing frequencies and endings are
   statistically compatible (Hoeffding bound), redrawing the tree below.
   The lengths and the least score of a kind come from all its values.
3. A second pass finds the *candidates*: unbroken runs of the credential
   alphabet and all their pieces between ``/``, ``=`` and ``.``, from
   ``ASSIGN_MIN`` characters on, that lie outside the base spans.  Each is
   scored by its likelihood under each automaton against a background of
   independent characters.  It is a span of kind ``inferred`` if some
   automaton accepts it, it is as long as labelled credentials are, and its
   score per character reaches theirs (the lowest percent of those that the
   automaton accepts aside).  Of overlapping ones the longest counts.

Null text counts as empty; offsets are code points, ends exclusive;
repeated rows are scanned one by one.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.llm.stage import written

KINDS = ("assign", "access", "hex")
INFERRED = "inferred"
# fixed patterns of the base kinds
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
ALPHABET = r"[A-Za-z0-9+/_.=-]"
PIECE_ENDS = "/=."
# cheap tests that never miss a text with a match
_MAYBE = {
    "assign": r"(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]",
    "access": r"AKIA", "hex": r"[0-9a-f]{%d}" % HEX_MIN,
}
SAMPLE = 1000
ALPHA = 0.05            # confidence of the merge test
SMOOTH = 0.05           # probability kept for unseen continuations
MIN_LABELLED = 5        # fewer values make no grammar
SCORE_STEP = 1e-4       # scores are counted in steps of this
MEMO = 300_000          # runs without a secret that a task remembers


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) by the base patterns."""
    out = []
    for m in _ASSIGN.finditer(text):
        if len(m[2]) >= ASSIGN_MIN:
            out.append(("assign", m.start(), m.end(), m[2]))
    for m in _ACCESS.finditer(text):
        if len(m[0]) >= ACCESS_MIN:
            out.append(("access", m.start(), m.end(), m[0]))
    for m in _LONG_HEX.finditer(text):
        out.append(("hex", m.start(), m.end(), m[0]))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _symbol(c: str) -> str:
    """Character classes of the grammars."""
    if c.isdigit():
        return "0"
    if "a" <= c <= "z":
        return "a" if c <= "f" else "z"
    if "A" <= c <= "Z":
        return "A" if c <= "F" else "Z"
    return c


class Automaton:
    """Deterministic probabilistic automaton inferred from strings."""

    def __init__(self, words: list[str], alpha: float = ALPHA) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.moves: list[Counter] = [Counter()]
        self.ends: list[int] = [0]
        for w in words:
            s = 0
            for c in map(_symbol, w):
                self.moves[s][c] += 1
                if c not in self.next[s]:
                    self.next[s][c] = len(self.next)
                    self.next.append({})
                    self.moves.append(Counter())
                    self.ends.append(0)
                s = self.next[s][c]
            self.ends[s] += 1
        self._bound = math.sqrt(0.5 * math.log(2.0 / alpha))
        self._infer()

    def _total(self, s: int) -> int:
        return self.ends[s] + sum(self.moves[s].values())

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self._bound * (
            1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        """Are the two states' futures statistically alike?"""
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            n1, n2 = self._total(x), self._total(y)
            if not n1 or not n2 or x == y:
                continue
            if self._differ(self.ends[x], n1, self.ends[y], n2):
                return False
            for c in self.moves[x].keys() | self.moves[y].keys():
                if self._differ(self.moves[x][c], n1, self.moves[y][c], n2):
                    return False
                if c in self.next[x] and c in self.next[y]:
                    todo.append((self.next[x][c], self.next[y][c]))
        return True

    def _fold(self, red: int, blue: int) -> None:
        """Add the tree below ``blue`` to the states from ``red`` on."""
        todo = [(red, blue)]
        while todo:
            x, y = todo.pop()
            self.ends[x] += self.ends[y]
            for c, n in self.moves[y].items():
                self.moves[x][c] += n
                if c in self.next[x]:
                    todo.append((self.next[x][c], self.next[y][c]))
                else:
                    self.next[x][c] = self.next[y][c]

    def _infer(self) -> None:
        red, blue = [0], [(0, c) for c in sorted(self.next[0])]
        while blue:
            # the most frequent border state first
            blue.sort(key=lambda e: -self.moves[e[0]][e[1]])
            parent, c = blue.pop(0)
            b = self.next[parent][c]
            for r in red:
                if self._compatible(r, b):
                    self.next[parent][c] = r
                    self._fold(r, b)
                    break
            else:
                red.append(b)
            known = set(red)
            blue = [(r, c) for r in red for c in sorted(self.next[r])
                    if self.next[r][c] not in known]

    def log_likelihood(self, word: str) -> float | None:
        """None if the automaton has no path for the word."""
        s, out = 0, 0.0
        for c in map(_symbol, word):
            if c not in self.next[s]:
                return None
            out += math.log((1 - SMOOTH) * self.moves[s][c] / self._total(s))
            s = self.next[s][c]
        if not self.ends[s]:
            return None
        return out + math.log(self.ends[s] / self._total(s))

    def tables(self, symbols: list[str], background: list[float]
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Next state (-1: no move) and log-likelihood ratio to the background
        of each state and symbol; log-probability of ending in each state."""
        n = len(self.next)
        go = np.full((n, len(symbols)), -1, np.int32)
        gain = np.zeros((n, len(symbols)))
        end = np.full(n, -math.inf)
        for s in range(n):
            total = self._total(s)
            for k, c in enumerate(symbols):
                if c in self.next[s]:
                    go[s, k] = self.next[s][c]
                    gain[s, k] = math.log((1 - SMOOTH) * self.moves[s][c]
                                          / total) - background[k]
            if self.ends[s]:
                end[s] = math.log(self.ends[s] / total)
        return go, gain, end


class Grammars:
    """One automaton of each kind; once ``limit`` is called, also its least
    score and lengths."""

    def __init__(self, labelled: dict[str, list[str]],
                 background: Counter) -> None:
        symbols = Counter()
        for c, n in background.items():
            symbols[_symbol(c)] += n
        total = sum(symbols.values()) + 70.0
        names = sorted({_symbol(c) for c in _IN_ALPHABET})
        back = [math.log((symbols[c] + 1.0) / total) for c in names]
        #: character -> number of its symbol
        self._code = np.zeros(128, np.int64)
        for c in _IN_ALPHABET:
            self._code[ord(c)] = names.index(_symbol(c))
        self.automata = {kind: Automaton(words)
                         for kind, words in labelled.items()
                         if len(words) >= MIN_LABELLED}
        self._tables = {kind: a.tables(names, back)
                        for kind, a in self.automata.items()}
        self._lists = {kind: [t.tolist() for t in tables]
                       for kind, tables in self._tables.items()}
        self.limits: dict[str, tuple[float, int, int]] = {}

    def limit(self, kind: str, least: float, lo: int, hi: int) -> None:
        self.limits[kind] = (least, lo, hi)

    @property
    def shortest(self) -> int:
        """No secret is shorter."""
        return max(ASSIGN_MIN, min(lo for _, lo, _ in self.limits.values()))

    def _codes(self, run: str) -> np.ndarray:
        return self._code[np.frombuffer(run.encode("ascii"), np.uint8)]

    def score(self, kind: str, word: str) -> float:
        """Log-likelihood ratio per character; -inf if the automaton has no
        path for the word."""
        go, gain, end = self._lists[kind]
        s, out = 0, 0.0
        for k in self._codes(word).tolist():
            out += gain[s][k]
            s = go[s][k]
            if s < 0:
                return -math.inf
        return (out + end[s]) / len(word)

    def secrets(self, run: str) -> list[tuple[int, int]]:
        """Every piece of a run, itself included, that is a secret.

        An automaton is walked once from the start of each piece, as far as it
        has moves and no further than its longest label, so the work is at
        most the run's length times that of the longest label."""
        starts, ends = self._pieces(run)
        codes, out = self._codes(run), set()
        for kind in self.limits:
            out.update(self._one_by_one(kind, codes.tolist(), starts, ends))
        return sorted(out)

    @staticmethod
    def _pieces(run: str) -> tuple[list[int], set[int]]:
        ends = {i for i, c in enumerate(run) if c in PIECE_ENDS}
        return [0, *sorted(i + 1 for i in ends)], ends | {len(run)}

    def longest_secrets(self, run: str, taken: list[tuple[int, int]]
                        ) -> list[tuple[int, int]]:
        """Of ``secrets`` those that touch no taken span, and of overlapping
        ones the longest, then the first; for runs of very many pieces."""
        starts, ends = self._pieces(run)
        free = np.zeros(len(run) + 1, np.int64)
        for s, e in taken:
            free[max(s, 0):max(min(e, len(run)), 0)] = 1
        by_length: dict[int, list[np.ndarray]] = {}
        upto = np.concatenate([[0], np.cumsum(free)])
        for kind in self.limits:
            for n, at in self._side_by_side(kind, self._codes(run), starts,
                                            ends):
                at = at[upto[at + n] == upto[at]]
                if len(at):
                    by_length.setdefault(n, []).append(at.astype(np.int32))
        out: list[tuple[int, int]] = []
        for n in sorted(by_length, reverse=True):
            at = np.unique(np.concatenate(by_length[n]))
            at = at[upto[at + n] == upto[at]]
            i = 0
            while i < len(at):
                s = int(at[i])
                out.append((s, s + n))
                free[s:s + n] = 1
                i = int(np.searchsorted(at, s + n))
            if len(at):
                np.cumsum(free, out=upto[1:])
        return sorted(out)

    def _one_by_one(self, kind: str, codes: list[int], starts: list[int],
                    ends: set[int]) -> Iterator[tuple[int, int]]:
        go, gain, end = self._lists[kind]
        least, lo, hi = self.limits[kind]
        lo = max(lo, ASSIGN_MIN)
        for start in starts:
            s, out = 0, 0.0
            for i in range(start, min(len(codes), start + hi)):
                k = codes[i]
                out += gain[s][k]
                s = go[s][k]
                if s < 0:
                    break
                n = i + 1 - start
                if n >= lo and i + 1 in ends and (out + end[s]) / n >= least:
                    yield start, i + 1

    def _side_by_side(self, kind: str, codes: np.ndarray, starts: list[int],
                      ends: set[int]) -> Iterator[tuple[int, np.ndarray]]:
        """(length, starts) of the finds."""
        go, gain, end = self._tables[kind]
        least, lo, hi = self.limits[kind]
        lo = max(lo, ASSIGN_MIN)
        is_end = np.zeros(len(codes) + 1, bool)
        is_end[list(ends)] = True
        start = np.array(starts)
        s, out = np.zeros(len(start), np.int64), np.zeros(len(start))
        for n in range(1, hi + 1):
            at = start + (n - 1)
            inside = at < len(codes)
            if not inside.all():
                start, s, out, at = (x[inside] for x in (start, s, out, at))
            k = codes[at]
            out = out + gain[s, k]
            s = go[s, k]
            alive = s >= 0
            if not alive.all():
                start, s, out = start[alive], s[alive], out[alive]
            if not len(start):
                return
            if n >= lo:
                found = is_end[start + n] & ((out + end[s]) / n >= least)
                if found.any():
                    yield n, start[found]


MANY_PIECES = 64        # runs of more pieces are not listed piece by piece


SPAN = (T.StructType().add("kind", T.StringType())
        .add("start", T.LongType()).add("end", T.LongType())
        .add("value", T.StringType()))


def _spans(texts: pa.Array) -> Iterator[list[tuple[int, int, int, str]]]:
    """The base spans of every text."""
    maybe = [pc.match_substring_regex(texts, p).to_pylist()
             for p in _MAYBE.values()]
    for i, any_of in enumerate(zip(*maybe, strict=True)):
        yield base_spans(texts[i].as_py()) if any(any_of) else []


BACKGROUND = "background"
_LABELLED = (T.StructType().add("kind", T.StringType())
             .add("value", T.StringType()).add("n", T.LongType()))
_IN_ALPHABET = [c for c in map(chr, range(128)) if re.match(ALPHABET, c)]


def _label(like: pa.Schema):
    """Different values of the base spans, and the characters' counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars = np.zeros(256, np.int64)
        for b in batches:
            texts = pc.fill_null(b.column(0), "")
            found = {(s[0], s[3]) for spans in _spans(texts) for s in spans}
            whole = texts.cast(pa.large_string())
            _, offsets, data = whole.buffers()
            if data is not None and len(whole):
                at = np.frombuffer(offsets, np.int64)[
                    whole.offset:whole.offset + len(whole) + 1]
                chars += np.bincount(np.frombuffer(data, np.uint8)[
                    at[0]:at[-1]], minlength=256)
            rows = [{"kind": k, "value": v, "n": 1} for k, v in sorted(found)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=like)
        yield pa.RecordBatch.from_pylist(
            [{"kind": BACKGROUND, "value": c, "n": int(chars[ord(c)])}
             for c in _IN_ALPHABET], schema=like)

    return run


def _found(g: Grammars, run: re.Pattern, text: str, plain: set[str],
           secret: dict[str, list[tuple[int, int]]],
           base: list[tuple[str, int, int, str]]
           ) -> list[tuple[int, int, str]]:
    """Secrets of a text; ``plain`` and ``secret`` are known runs."""
    runs = set(run.findall(text))
    many = {r for r in runs - plain if len(r) > MANY_PIECES
            and sum(map(r.count, PIECE_ENDS)) > MANY_PIECES}
    for r in runs - plain - many:
        if r not in secret:
            pieces = g.secrets(r)
            if pieces:
                secret[r] = pieces
            elif len(plain) < MEMO and len(r) < 200:
                plain.add(r)
    if runs.isdisjoint(secret) and not many:
        return []
    out = []
    for m in run.finditer(text):
        at = m.start()
        found = secret.get(m[0], ()) if m[0] not in many else \
            g.longest_secrets(m[0], [
                (s - at, e - at) for _, s, e, _ in base
                if e > at and s < m.end()])
        out += [(at + s, at + e, m[0][s:e]) for s, e in found]
    return out


def _outside(found: list[tuple[int, int, str]],
             base: list[tuple[str, int, int, str]]
             ) -> list[tuple[int, int, str]]:
    """Those that touch no base span and no longer one of their own."""
    taken = sorted((s, e) for _, s, e, _ in base)
    begins = [s for s, _ in taken]
    reach = [0, *accumulate((e for _, e in taken), max)]
    free = [f for f in sorted(found)
            if reach[bisect_left(begins, f[1])] <= f[0]]
    # of overlapping finds the longest, then the first
    out: list[tuple[int, int, str]] = []
    for f in sorted(free, key=lambda f: (f[0] - f[1], f[0])):
        at = bisect_left(out, f)
        if (at == 0 or out[at - 1][1] <= f[0]) and (
                at == len(out) or f[1] <= out[at][0]):
            out.insert(at, f)
    return out


def _judge(grammars, like: pa.Schema):
    def text_of(spans: list[tuple]) -> str:
        return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)

    order = {k: i for i, k in enumerate((*KINDS, INFERRED))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = grammars.value
        pattern = re.compile(ALPHABET + "{%d,}" % g.shortest
                             ) if g.limits else None
        plain: set[str] = set()
        secret: dict[str, list[tuple[int, int]]] = {}
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            out: list[list] = [[] for _ in range(6)]
            for i, base in enumerate(_spans(texts)):
                more = []
                if pattern is not None:
                    if len(secret) > MEMO:
                        secret.clear()
                    more = _outside(_found(g, pattern, texts[i].as_py(),
                                           plain, secret, base), base)
                kinds = Counter(s[0] for s in base)
                every = sorted(base + [(INFERRED, *m) for m in more],
                               key=lambda s: (s[1], order[s[0]]))
                for col, v in zip(out, (
                        *(kinds[k] for k in KINDS), hashlib.sha256(
                            text_of(base).encode()).hexdigest(),
                        text_of(every), [dict(zip(
                            ("kind", "start", "end", "value"), s,
                            strict=True)) for s in every]), strict=True):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, f.type) for c, f in zip(
                    out, list(like)[1:], strict=True)]], schema=like)

    return run


def _score(grammars, like: pa.Schema):
    """Length and score of every labelled value."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = grammars.value
        for b in batches:
            kinds, words = (c.to_pylist() for c in b.columns)
            score = [g.score(k, w) for k, w in zip(kinds, words, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(map(len, words), pa.int64()),
                 pa.array([None if x == -math.inf else
                           math.floor(x / SCORE_STEP) for x in score],
                          pa.int64())], schema=like)

    return run


def infer_grammars(labels: DataFrame, sample: int = SAMPLE) -> Grammars:
    """Grammars of the labelled values ``(kind, value, n)`` of a scan."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = labels.sparkSession
    values = labels.filter(F.col("kind") != BACKGROUND).select(
        "kind", "value").distinct()
    counts = {r[0]: r[1] for r in values.groupBy("kind").count().collect()}
    if not counts:
        return Grammars({}, Counter())
    # at most about 8 x sample values of a kind are ranked
    share = F.create_map(*[x for k, n in counts.items() for x in (
        F.lit(k), F.lit(min(1.0, 8.0 * sample / n)))])
    key = F.xxhash64("value")
    w = Window.partitionBy("kind").orderBy("key", "value")
    rows = (values.withColumn("key", key)
            .filter(F.shiftrightunsigned("key", 11) * 2.0 ** -53
                    <= share[F.col("kind")])
            .withColumn("r", F.row_number().over(w))
            .filter(F.col("r") <= sample).select("kind", "value")
            .orderBy("kind", "r").toArrow().to_pylist())
    labelled: dict[str, list[str]] = {}
    for r in rows:
        labelled.setdefault(r["kind"], []).append(r["value"])
    chars = (labels.filter(F.col("kind") == BACKGROUND).groupBy("value")
             .agg(F.sum("n")).collect())
    g = Grammars(labelled, Counter({r[0]: r[1] for r in chars}))
    if not g.automata:
        return g
    # lengths and scores of all values: a row for each step of the scores
    schema = (T.StructType().add("kind", T.StringType())
              .add("size", T.LongType()).add("step", T.LongType()))
    steps = (values.filter(F.col("kind").isin(list(g.automata)))
             .mapInArrow(_score(spark.sparkContext.broadcast(g),
                                to_arrow_schema(schema)), schema)
             .groupBy("kind", "step").agg(
                 F.count(F.lit(1)), F.min("size"), F.max("size")).collect())
    for kind in g.automata:
        own = sorted((s, n) for k, s, n, _, _ in steps
                     if k == kind and s is not None)
        rank = sum(n for _, n in own) // 100
        for step, n in own:
            if rank < n:
                g.limit(kind, step * SCORE_STEP,
                        min(r[3] for r in steps if r[0] == kind),
                        max(r[4] for r in steps if r[0] == kind))
                break
            rank -= n
    return g


def scan_secrets(docs: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id, n_assign, n_access, n_hex, base_sha256, spans`` (as text) and
    ``found`` (kind, start, end, value) of every row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    key = T.StructField("id", docs.schema[id_col].dataType)
    labels = written(docs.select(text_col).mapInArrow(
        _label(to_arrow_schema(_LABELLED)), _LABELLED), "secrets")
    grammars = spark.sparkContext.broadcast(infer_grammars(labels))
    out = T.StructType([key, *[T.StructField(f"n_{k}", T.LongType())
                               for k in KINDS],
                        T.StructField("base_sha256", T.StringType()),
                        T.StructField("spans", T.StringType()),
                        T.StructField("found", T.ArrayType(SPAN))])
    return docs.select(id_col, text_col).mapInArrow(_judge(grammars, to_arrow_schema(out)), out)


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    from textflow.llm.stage import documents
    return scan_secrets(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex",
        "base_sha256", "spans")
