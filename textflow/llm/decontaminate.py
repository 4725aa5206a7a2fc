"""Benchmark decontamination: test suffixes searched in sorted training text.

A shard is a few MB of whole documents (words are ``[0-9a-z]`` and non-ASCII
bytes after lower-casing A-Z).  A Bloom table and a match on the first three
words pick the positions of a shard at which some test suffix -- a position
of a benchmark item -- can begin; only these enter the array, which sorts
them by their first 13 words.  It is no suffix array of the whole shard: no
other position can match even three words, so nothing is lost.  Every test
suffix whose three words occurred is binary-searched in it; the range of equal
heads gives all verbatim locations of the suffix's window, and each location
is extended to the longest verbatim match.

The benchmark is cut into blocks of at most ``block_bytes`` of text.  Blocks
are applied one after the other in one narrow plan, so a benchmark of any
size is searched in full, and no document is shuffled.

A window is 13 consecutive words of an item, or the whole item if it has
fewer (but some) words.  A document word inside any occurrence of a window
is hit.  Null texts have no words; null item ids are left out of item lists;
repeated rows are judged one by one.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.llm.words import WORDS, mix, word_runs

WINDOW = 13
ANCHOR = 3                  # first words a suffix must share with a test one
BLOCK_BYTES = 16 << 20      # benchmark text broadcast at once
_BITS = 20

SPAN = T.StructType().add("start", T.LongType()).add("end", T.LongType())
MATCH = (T.StructType().add("item_id", T.StringType())
         .add("item_pos", T.LongType()).add("doc_pos", T.LongType())
         .add("n_words", T.LongType()))


def _anchor(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from every position (positions past the end
    read zeros)."""
    padded = np.concatenate([h, np.zeros(n, np.uint64)])
    a = np.zeros(len(h), np.uint64)
    for i in range(n):
        a = mix(a ^ padded[i:i + len(h)])
    return a


class TestSuffixes:
    """All suffixes of one block of items, ready to be searched."""

    __test__ = False

    def __init__(self, items: list[tuple[str | None, bytes]]) -> None:
        """``items``: (item id, word hashes as bytes), items without words
        left out."""
        self.ids = [i for i, _ in items]
        self.words = [np.frombuffer(b, np.uint64) for _, b in items]
        self.anchor_words = min([ANCHOR, *(len(w) for w in self.words)])
        item, pos, size, anchors = [], [], [], []
        for k, w in enumerate(self.words):
            n = min(WINDOW, len(w))
            at = np.arange(len(w) - n + 1)
            item.append(np.full(len(at), k))
            pos.append(at)
            size.append(np.full(len(at), n))
            anchors.append(_anchor(w, self.anchor_words)[:len(at)])
        cat = (lambda x: np.concatenate(x) if x else np.zeros(0, np.int64))
        self.item, self.pos, self.size = cat(item), cat(pos), cat(size)
        self.anchor = cat(anchors).astype(np.uint64)
        self.anchors = np.unique(self.anchor)
        self.bloom = np.zeros(1 << _BITS, bool)
        self.bloom[self.anchors >> np.uint64(64 - _BITS)] = True
        self.key = [self.words[k][p:p + n].astype(">u8").tobytes()
                    for k, p, n in zip(self.item, self.pos, self.size,
                                       strict=True)]

    def search(self, h: np.ndarray, ptr: np.ndarray
               ) -> Iterator[tuple[int, int, int]]:
        """(test suffix, shard position, row) of every window occurrence."""
        if not len(self.anchors) or not len(h):
            return
        a = _anchor(h, self.anchor_words)
        at = np.flatnonzero(self.bloom[a >> np.uint64(64 - _BITS)])
        near = np.searchsorted(self.anchors, a[at])
        near[near == len(self.anchors)] = 0
        at = at[self.anchors[near] == a[at]]
        if not len(at):
            return
        row = np.searchsorted(ptr, at, "right") - 1
        # the suffixes' first words; past the end of a document reads 0
        idx = at[:, None] + np.arange(WINDOW)
        inside = idx < ptr[row + 1][:, None]
        head = np.where(inside, h[np.minimum(idx, len(h) - 1)], 0)
        raw = [r.tobytes() for r in head.astype(">u8")]
        order = sorted(range(len(at)), key=raw.__getitem__)
        suffixes = [raw[i] for i in order]
        present = np.isin(self.anchor, a[at])
        for s in np.flatnonzero(present):
            key = self.key[s]
            lo = bisect_left(suffixes, key)
            hi = bisect_right(suffixes, key + b"\xff" * (
                8 * (WINDOW - int(self.size[s]))), lo)
            for i in range(lo, hi):
                yield int(s), int(at[order[i]]), int(row[order[i]])

    def longest(self, s: int, h: np.ndarray, p: int, end: int) -> int:
        """Words that test suffix ``s`` and the text at ``p`` share."""
        w = self.words[self.item[s]][self.pos[s]:]
        n = min(len(w), end - p)
        same = w[:n] == h[p:p + n]
        return n if same.all() else int(np.argmin(same))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _pass(block, text_col: str, like: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = TestSuffixes(block.value)
        for b in batches:
            col = {f.name: b.column(i) for i, f in enumerate(b.schema)}
            texts = col["row"].field(text_col)
            for r in word_runs(texts, WORDS):
                n = r.rows
                spans, items, found = (defaultdict(list), defaultdict(set),
                                       defaultdict(list))
                if "spans" in col:
                    for i in range(n):
                        old = {c: col[c][r.first + i].as_py()
                               for c in ("spans", "items", "matches")}
                        if old["spans"]:
                            spans[i] = [(x["start"], x["end"])
                                        for x in old["spans"]]
                            items[i] = set(old["items"])
                            found[i] = old["matches"]
                for s, p, i in tests.search(r.hash, r.ptr):
                    at = p - int(r.ptr[i])
                    spans[i].append((at, at + int(tests.size[s])))
                    item, q = int(tests.item[s]), int(tests.pos[s])
                    name = tests.ids[item]
                    if name is not None:
                        items[i].add(name)
                    if q and at and (tests.words[item][q - 1]
                                     == r.hash[p - 1]):
                        continue        # inside a match that starts earlier
                    found[i].append({
                        "item_id": name, "item_pos": q, "doc_pos": at,
                        "n_words": tests.longest(s, r.hash, p,
                                                 int(r.ptr[i + 1]))})
                merged = [_merged(spans[i]) if i in spans else []
                          for i in range(n)]
                cols = {
                    "row": col["row"].slice(r.first, n),
                    "n_words": np.diff(r.ptr),
                    "n_hit": [sum(e - s for s, e in m) for m in merged],
                    "spans": [[{"start": s, "end": e} for s, e in m]
                              for m in merged],
                    "items": [sorted(items[i]) if i in items else []
                              for i in range(n)],
                    "matches": [found.get(i, []) for i in range(n)],
                }
                cols["n_items"] = [len(x) for x in cols["items"]]
                cols["items_sha256"] = [hashlib.sha256(",".join(x).encode())
                                        .hexdigest() for x in cols["items"]]
                out = []
                for f in like:
                    v = cols[f.name]
                    v = v if isinstance(v, pa.Array) else pa.array(v, f.type)
                    out.append(v.cast(f.type))
                yield pa.RecordBatch.from_arrays(out, schema=like)

    return run


def _items(benchmark: DataFrame, item_col: str, text_col: str, block: int,
           blocks: int) -> list[tuple[str | None, bytes]]:
    rows = (benchmark.select(F.col(item_col).cast("string").alias("i"),
                             F.col(text_col).alias("t"))
            .filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
            .distinct().toArrow())
    ids = rows["i"].to_pylist()
    out = []
    for r in word_runs(rows["t"], WORDS):
        for i in range(r.rows):
            h = r.hash[r.ptr[i]:r.ptr[i + 1]]
            if len(h):
                out.append((ids[r.first + i], h.tobytes()))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame,
                       text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", carry=None,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row of ``docs`` with what of the benchmark it contains.

    Columns: ``row`` (struct of the columns in ``carry``, default all),
    ``n_words``, ``n_hit``, ``spans`` (hit word ranges), ``items``,
    ``n_items``, ``items_sha256``, ``matches`` (longest verbatim matches
    with their places) and ``contaminated``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    carry = docs.columns if carry is None else list(carry)
    cols = list(dict.fromkeys([*carry, text_col]))
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols])
                      .alias("row"))
    schema = T.StructType([
        out.schema["row"], T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("spans", T.ArrayType(SPAN)),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("matches", T.ArrayType(MATCH))])
    size = benchmark.agg(F.sum(F.octet_length(item_text_col))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for k in range(blocks):
        block = spark.sparkContext.broadcast(
            _items(benchmark, item_col, item_text_col, k, blocks))
        out = out.mapInArrow(_pass(block, text_col,
                                   to_arrow_schema(schema)), schema)
    return out.withColumn("contaminated", (F.col("n_hit") > 0)
                          & (20 * F.col("n_hit") >= F.col("n_words")))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, all columns kept."""
    return (find_contamination(docs, benchmark)
            .filter(~F.col("contaminated")).select("row.*"))


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    from textflow.llm.stage import documents
    found = find_contamination(
        documents(spark, sf_dir).select("doc_id", "text"),
        documents(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", "n_words", "n_hit", "n_items",
                        "items_sha256", "contaminated")
