"""Spelling variants: words one edit apart, by blocked Gram matrices.

Words.  Runs of ``A-Za-z`` and U+00C0 to U+00FF are found on the UTF-8
buffer; a checksum of ``<id>:<run>``, computed for all runs of a batch at once
byte position by byte position, says which occurrences lose a letter.  Every
occurrence of a run in one text has the same checksum.  Words of at least
seven code points with their number of occurrences are the vocabulary.

Near words.  A word is the vector of its letter counts.  One inserted or
deleted letter gives a squared distance of 1, one replaced letter 2, so
``|a|^2 + |b|^2 - 2 a.b <= 2`` between words of the same or adjacent lengths
loses no pair; products of count blocks give it for all pairs of two blocks,
and what is left is verified letter by letter.

Blocks.  One edit changes the counts of at most two letters.  The letters are
dealt into four parts of about equal frequency, so two near words agree in the
counts of at least two whole parts: each word is filed under its counts in
each of the six pairs of parts, and only words of one file are multiplied, in
blocks of adjacent lengths.  A pair that meets in several files counts in the
first.  A file of more than ``TILE`` words is cut into tiles by a hash, and
each pair of tiles is a block of its own, so no task holds more than two
tiles; nothing is left out.

Forms.  A word's near words are reduced to their number and the most frequent
one.  A form has ten times the word's occurrences, so chains have less than 19
steps; ``root`` follows them by doubling.

Null text has no words; a null id counts as an empty one; repeated rows count
as occurrences of their own.  A text of any length is read whole.  No words:
no rows.  Only the id and text columns are read, so other columns cannot
clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.llm.stage import partitions, written
from textflow.llm.words import Runs, hash_runs, pieces, ranges, spread

MIN_LETTERS = 7
MIN_COUNT = 2
DROP_EVERY = 31         # an occurrence whose checksum this divides
FORM_FACTOR = 10        # a form has at least so many times the occurrences

LETTERS = [*map(chr, range(97, 123)), *map(chr, range(0xC0, 0x100))]
_COLUMN = np.zeros(256, np.int64)        # code point -> column
for _i, _c in enumerate(LETTERS):
    _COLUMN[ord(_c)] = _i
PARTS = 4
PAIRS = list(combinations(range(PARTS), 2))
TILE = 2048

# ---------------------------------------------------------------- words

_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[65:91] += 32
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[65:91] = _IS_LETTER[97:123] = True
_LEAD = 0xC3            # first byte of U+00C0 to U+00FF, and of nothing else


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def letter_runs(texts: pa.Array) -> Iterator[Runs]:
    """Maximal letter runs of every row, A-Z lower-cased."""
    for first, raw, off in pieces(texts):
        n = len(raw)
        m = _ASCII_LOWER[raw]
        in_run = np.zeros(n + 2, bool)
        w = in_run[1:-1]
        w[:] = _IS_LETTER[raw] | (raw == _LEAD)
        if n:
            w[1:] |= raw[:-1] == _LEAD
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        start = np.flatnonzero(w & (~in_run[:-2] | edge[:n]))
        end = np.flatnonzero(w & (~in_run[2:] | edge[1:])) + 1
        yield hash_runs(first, m, start, end, off)


def _crc_after(state: np.ndarray, buf: np.ndarray, start: np.ndarray,
               end: np.ndarray) -> np.ndarray:
    """CRC-32 states of all runs after their bytes, one byte position of all
    runs at a time."""
    state = state.copy()
    live = np.argsort(start - end, kind="stable")       # longest first
    size = (end - start)[live]
    for k in range(int(size[0]) if len(size) else 0):
        live = live[:np.searchsorted(-size, -k, "left")]
        s = state[live]
        state[live] = _CRC[(s ^ buf[start[live] + k]) & np.uint32(0xFF)] ^ (
            s >> np.uint32(8))
    return state


def _runs_to_words(ids: list[str], r: Runs
                   ) -> tuple[list[bytes], np.ndarray]:
    """Distinct words of a piece, after the loss of letters, with their
    occurrences."""
    lead = np.zeros(len(r.buf) + 1, np.int64)
    np.cumsum(r.buf == _LEAD, out=lead[1:])
    letters = r.end - r.start - (lead[r.end] - lead[r.start])
    row = spread(np.diff(r.ptr))
    keep = letters >= MIN_LETTERS
    start, end, letters, row, h = (x[keep] for x in (
        r.start, r.end, letters, row, r.hash))
    # CRC-32 of "<id>:" goes before the bytes of each run
    heads = np.frombuffer("".join(ids).encode(), np.uint8)
    size = np.array([len(x) for x in ids], np.int64)
    head_end = np.cumsum(size)
    state = _crc_after(np.full(len(ids), 0xFFFFFFFF, np.uint32), heads,
                       head_end - size, head_end)
    crc = _crc_after(state[row], r.buf, start, end) ^ np.uint32(0xFFFFFFFF)
    cut = crc % DROP_EVERY == 0
    words, counts = [], []
    _, at, n = np.unique(h[~cut], return_index=True, return_counts=True)
    lo, hi = start[~cut][at], end[~cut][at]
    data = r.buf.tobytes()
    words += [data[a:b] for a, b in zip(lo.tolist(), hi.tolist(),
                                        strict=True)]
    counts += n.tolist()
    for i in np.flatnonzero(cut & (letters > MIN_LETTERS)):
        w = data[start[i]:end[i]].decode()
        p = int(crc[i]) % len(w)
        words.append((w[:p] + w[p + 1:]).encode())
        counts.append(1)
    return words, np.array(counts, np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids = [f"{x}:" for x in pc.fill_null(
            b.column(0).cast(pa.string()), "").to_pylist()]
        for r in letter_runs(b.column(1)):
            words, n = _runs_to_words(ids[r.first:r.first + r.rows], r)
            if words:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.binary()).cast(pa.string()),
                     pa.array(n)], names=["word", "n"])


_COUNTED = T.StructType([T.StructField("word", T.StringType()),
                         T.StructField("n", T.LongType())])


def vocabulary(docs: DataFrame, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``word, n`` of all words of ``docs``."""
    rows = docs.select(F.col(f"`{id_col}`").cast("string"),
                       F.col(f"`{text_col}`")).mapInArrow(_count, _COUNTED)
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= MIN_COUNT)


# ------------------------------------------------------------ letter counts


class Letters:
    """The words of an Arrow array: letter codes, lengths, letter counts."""

    def __init__(self, words: pa.Array) -> None:
        flat, off = [np.zeros(0, np.uint8)], [np.zeros(1, np.int64)]
        for _, raw, ends in pieces(words):
            keep = raw != _LEAD
            upto = np.concatenate([[0], np.cumsum(keep)])
            off.append(upto[ends[1:]] + off[-1][-1])
            raw = raw[keep]
            flat.append(np.where(raw < 128, raw, raw + 64).astype(np.uint8))
        self.flat, self.off = np.concatenate(flat), np.concatenate(off)
        self.size = np.diff(self.off)
        self.counts = np.bincount(
            spread(self.size) * len(LETTERS) + _COLUMN[self.flat],
            minlength=len(self.size) * len(LETTERS)).reshape(
                len(self.size), len(LETTERS))

    def parts(self, part: np.ndarray) -> np.ndarray:
        """Rows x parts: 64-bit hashes of the counts in each part."""
        rnd = np.random.default_rng(7)
        weight = rnd.integers(0, 2 ** 63, len(LETTERS), np.uint64
                              ) * np.uint64(2) + np.uint64(1)
        c = self.counts.astype(np.uint64)
        return np.stack([c[:, part == k] @ weight[part == k]
                         for k in range(PARTS)], 1)

    def codes(self, rows: np.ndarray) -> np.ndarray:
        """Matrix of the rows' letters, 0 after the end of a word."""
        size = self.size[rows]
        out = np.zeros((len(rows), int(size.max(initial=1))), np.uint8)
        out[spread(size), ranges(np.zeros(len(rows), np.int64), size)] = \
            self.flat[ranges(self.off[rows], size)]
        return out


def letter_parts(words: DataFrame) -> np.ndarray:
    """The part of every letter, by the letters' number in the vocabulary (a
    table of at most ``len(LETTERS)`` rows)."""
    letters = words.select(F.explode(F.split("word", "")).alias("c")).groupBy(
        "c").agg(F.count(F.lit(1)).alias("n"))
    load, part = [0] * PARTS, np.zeros(len(LETTERS), np.int64)
    for r in sorted(letters.collect(), key=lambda r: (-r.n, r.c)):
        if r.c:
            k = load.index(min(load))
            load[k] += r.n
            part[_COLUMN[ord(r.c)]] = k
    return part


def _file(part: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = Letters(b.column(0)).parts(part)
            for k, (i, j) in enumerate(PAIRS):
                key = (own[:, i] * np.uint64(0x9E3779B97F4A7C15)
                       + own[:, j]) * np.uint64(0xD6E8FEB86659FD93)
                key ^= key >> np.uint64(32)
                key = key * np.uint64(8) + np.uint64(k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), b.column(0), b.column(1)],
                    names=["key", "word", "n"])

    return run


_FILED = T.StructType([T.StructField("key", T.LongType()), *_COUNTED.fields])

# ------------------------------------------------------------ Gram blocks


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two code matrices of one width differ by exactly one
    edit; a word of ``b`` is as long as that of ``a`` or one longer."""
    same = a == b
    equal_long = (a != 0).sum(1) == (b != 0).sum(1)
    # common prefix, then b without its next letter must go on like a
    width = a.shape[1]
    head = np.where(same.all(1), width, np.argmin(same, 1))
    shifted = np.zeros_like(b)
    shifted[:, :-1] = b[:, 1:]
    tail = (a == shifted) | (np.arange(width)[None, :] < head[:, None])
    return np.where(equal_long, (~same).sum(1) == 1, tail.all(1))


SMALL_BLOCKS = (4, 8, 16, 32)       # widths of blocks multiplied together
_CELLS = 4 << 20


class Blocks:
    """Words in blocks (``start[k]`` to ``end[k]``), sorted by length in each;
    ``pair[k]`` is the pair of parts they agree in."""

    def __init__(self, words: pa.Array, side: np.ndarray, start: np.ndarray,
                 end: np.ndarray, pair: np.ndarray, part: np.ndarray) -> None:
        self.letters, self.side = Letters(words), side
        self.size = self.letters.size
        self.start, self.end, self.pair = start, end, pair
        self.own = self.letters.parts(part)
        exact = np.float32 if self.size.max(initial=0) <= 2000 else np.float64
        counts = self.letters.counts
        self.counts = counts[:, counts.any(0)].astype(exact)
        self.square = (self.counts ** 2).sum(1)

    def _together(self, blocks: np.ndarray, width: int
                  ) -> Iterator[tuple[np.ndarray, ...]]:
        """Close pairs of many small blocks: one product of a stack."""
        step = max(1, _CELLS // (width * (width + self.counts.shape[1])))
        for lo in range(0, len(blocks), step):
            k = blocks[lo:lo + step]
            at = self.start[k][:, None] + np.arange(width)[None, :]
            real = at < self.end[k][:, None]
            at = np.where(real, at, self.start[k][:, None])
            c = self.counts[at]
            square, size = self.square[at], self.size[at]
            gram = c @ c.transpose(0, 2, 1)
            close = (square[:, :, None] + square[:, None, :] - 2 * gram) <= 2
            close &= np.abs(size[:, :, None] - size[:, None, :]) <= 1
            close &= real[:, :, None] & real[:, None, :]
            close &= np.triu(np.ones((width, width), bool), 1)
            b, i, j = np.nonzero(close)
            yield at[b, i], at[b, j], self.pair[k[b]]

    def _alone(self, k: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Close pairs of one block: products of adjacent length blocks."""
        lo0, hi0 = int(self.start[k]), int(self.end[k])
        size = self.size[lo0:hi0]
        c = self.counts[lo0:hi0]
        c = c[:, (c != c[:1]).any(0)]       # equal counts: no distance
        square, one = (c ** 2).sum(1)[:, None], np.ones((len(c), 1), c.dtype)
        # |a|^2 + |b|^2 - 2 a.b as one product
        left = np.concatenate([-2 * c, square, one], 1)
        right = np.concatenate([c, one, square], 1)
        for n in np.unique(size):
            lo, hi = np.searchsorted(size, [n, n + 1])
            for m in (n, n + 1):
                lo2, hi2 = np.searchsorted(size, [m, m + 1])
                if lo2 == hi2:
                    continue
                at = np.flatnonzero(left[lo:hi] @ right[lo2:hi2].T <= 2)
                i, j = at // (hi2 - lo2) + lo, at % (hi2 - lo2) + lo2
                if n == m:
                    i, j = i[i < j], j[i < j]
                yield i + lo0, j + lo0, np.full(len(i), self.pair[k])

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (i, j) of words one edit apart that count here."""
        found, waiting, size = [], [], 0
        for close in self._close():
            waiting.append(close)
            size += len(close[0])
            if size > _CELLS:
                found.append(self._verified(waiting))
                waiting, size = [], 0
        if waiting:
            found.append(self._verified(waiting))
        none = np.zeros(0, np.int64)
        return (np.concatenate([none, *(f[0] for f in found)]),
                np.concatenate([none, *(f[1] for f in found)]))

    def _close(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(i, j, pair of parts) of words at most two apart."""
        n = self.end - self.start
        below = 1
        for width in SMALL_BLOCKS:
            mine = np.flatnonzero((n > below) & (n <= width))
            yield from self._together(mine, width)
            below = width
        for k in np.flatnonzero(n > below):
            yield from self._alone(k)

    def _verified(self, close: list[tuple[np.ndarray, ...]]
                  ) -> tuple[np.ndarray, np.ndarray]:
        i, j, pair = map(np.concatenate, zip(*close, strict=True))
        # of the two sides of a pair of tiles
        ok = (self.side[i] | self.side[j]) == 3
        # in the first file they share; a key may be shared by chance only
        same = self.own[i] == self.own[j]
        first = np.full(len(i), len(PAIRS))
        for k in reversed(range(len(PAIRS))):
            a, b = PAIRS[k]
            first[same[:, a] & same[:, b]] = k
        ok &= first == pair
        i, j = i[ok], j[ok]
        order = np.argsort(self.size[j], kind="stable")
        i, j = i[order], j[order]
        ok = np.zeros(len(i), bool)
        lo = 0
        while lo < len(i):
            step = max(1, _CELLS // int(self.size[j[lo]] + 1))
            s = slice(lo, lo + step)
            a, b = self.letters.codes(i[s]), self.letters.codes(j[s])
            if a.shape[1] < b.shape[1]:
                a = np.pad(a, ((0, 0), (0, b.shape[1] - a.shape[1])))
            ok[s] = one_edit(a, b)
            lo += step
        return i[ok], j[ok]


_NEAR = T.StructType([
    T.StructField("word", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField("other", T.StringType()),
    T.StructField("other_n", T.LongType())])


def _multiply(part: np.ndarray):
    """Rows (key, word, n, tile, side) sorted by key, tile and length -> both
    directions of every near pair."""
    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        key, tile = t["key"].to_numpy(), t["tile"].to_numpy()
        new = np.flatnonzero((key[1:] != key[:-1])
                             | (tile[1:] != tile[:-1])) + 1
        start = np.concatenate([[0], new])
        end = np.concatenate([new, [len(key)]])
        many = end - start > 1          # a word alone has no neighbour here
        start, end = start[many], end[many]
        use = ranges(start, end - start)
        end = np.cumsum(end - start)
        start = np.concatenate([[0], end[:-1]]) if len(end) else end
        words = t["word"].combine_chunks().take(pa.array(use))
        n, side = t["n"].to_numpy()[use], t["side"].to_numpy()[use]
        i, j = Blocks(words, side, start, end, key[use][start] & 7,
                      part).near()
        a, b = np.concatenate([i, j]), np.concatenate([j, i])
        return pa.RecordBatch.from_arrays(
            [words.take(pa.array(a)), pa.array(n[a]),
             words.take(pa.array(b)), pa.array(n[b])], schema=_ARROW_NEAR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            key, tile = (b.column(c).to_numpy() for c in ("key", "tile"))
            # rows of the last block of this batch wait for the next batch
            last = np.flatnonzero((key != key[-1]) | (tile != tile[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if held and (cut or held[-1].column("key")[0].as_py() != key[0]
                         or held[-1].column("tile")[0].as_py() != tile[0]):
                if cut:
                    held.append(b.slice(0, cut))
                yield flush(held)
                held = []
            elif cut:
                yield flush([b.slice(0, cut)])
            held.append(b.slice(cut))
        if held:
            yield flush(held)

    return run


_ARROW_NEAR = pa.schema([("word", pa.string()), ("n", pa.int64()),
                         ("other", pa.string()), ("other_n", pa.int64())])


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``word, n, other, other_n`` of all ordered pairs of near words."""
    spark = words.sparkSession
    part = letter_parts(words)
    filed = words.mapInArrow(_file(part), _FILED)
    large = written(filed.groupBy("key").agg(
        F.count(F.lit(1)).alias("size")).filter(F.col("size") > tile),
        "files")
    one = [F.lit(0).cast("long").alias("tile"), F.lit(3).alias("side")]
    if large.isEmpty():
        dealt = filed.select("key", "word", "n", *one)
    else:
        # tiles by hash; a word goes to all pairs of tiles its own is in
        tiles = F.ceil(F.col("size") * 2 / tile).cast("long")
        mine = F.pmod(F.xxhash64("word", "key"), F.col("tiles"))
        low, high = F.least("mine", "t"), F.greatest("mine", "t")
        side = F.when(F.col("mine") == F.col("t"), 3).when(
            F.col("mine") < F.col("t"), 1).otherwise(2)
        cut = (filed.join(large, "key").withColumn("tiles", tiles)
               .withColumn("mine", mine)
               .withColumn("t", F.explode(F.sequence(
                   F.lit(0).cast("long"), F.col("tiles") - 1)))
               .select("key", "word", "n",
                       (low * F.col("tiles") + high).alias("tile"),
                       side.alias("side")))
        dealt = filed.join(large, "key", "left_anti").select(
            "key", "word", "n", *one).union(cut)
    dealt = dealt.repartition(partitions(spark), "key", "tile"
                              ).sortWithinPartitions("key", "tile", F.length("word"))
    return dealt.mapInArrow(_multiply(part), _NEAR)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the rows of ``forms`` (``word, form``): the last word
    that following the forms leads to."""
    to = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = to.select(F.col("word").alias("root"),
                          F.col("root").alias("after"))
        further = to.join(after, "root")
        if further.isEmpty():
            return to
        to = written(to.join(after, "root", "left").select(
            "word", F.coalesce("after", "root").alias("root")), "roots")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs``."""
    words = written(vocabulary(docs, id_col, text_col), "words")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("neg"),
                       F.col("other").alias("other"))).alias("top"))
    rows = words.join(best, "word", "left").withColumn(
        "form_n", -F.col("top.neg"))
    rows = rows.withColumn("form", F.when(
        F.col("form_n") >= FORM_FACTOR * F.col("n"), F.col("top.other")))
    rows = written(rows.select(
        "word", "form", "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("form_n")).alias("form_n")),
        "forms")
    root = roots(rows.filter(F.col("form").isNotNull()))
    return rows.join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        "n_near", "form_n")


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    from textflow.llm.stage import documents
    return spelling_groups(documents(spark, sf_dir))
