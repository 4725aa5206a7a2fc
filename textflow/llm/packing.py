"""Best-fit decreasing packing of documents into fixed-length sequences.

Every text is encoded, an end id is appended, and only what is longer than a
sequence is cut.  Best-fit decreasing takes the pieces from the longest to
the shortest and puts each into the open sequence with the least room that
still holds it.  Which sequence that is depends on the lengths alone, so the
order is computed from the number of pieces of each length -- a table of at
most ``capacity`` rows, whatever the corpus holds -- and the pieces follow it
in Spark:

* the encoding pass numbers the pieces of each length inside a partition, the
  counts per (partition, length) give each piece its number among all pieces
  of its length;
* the planner keeps sequences with the same fill together as one *bin group*
  and a segment tree over remaining capacities; the tightest open capacity
  for a length is one descent of the tree.  The pieces of one length fill a
  whole bin group at once, which is what placing them one by one does: after
  a piece is put into the tightest sequence, this sequence is still the
  tightest one until the length no longer fits;
* its result is a table of *runs*: (length, first number, last number) ->
  first sequence, pieces per sequence, offset.  A piece finds its run by
  binary search.

A length touches a group as a whole or splits it at most twice, and a group
that is touched as a whole keeps less than half of its room, so there are
fewer than ``4 * capacity`` groups and ``(log2(capacity) + 3)`` runs for each;
that bounds the broadcast table.

Null text counts as empty and is one piece, the end id alone.  Repeated rows
and null ids are packed as rows of their own.  A text of any length is
encoded whole and cut into full pieces and a rest.  No documents: no pieces.
Only the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.llm.stage import written
from textflow.llm.wordpiece import chunk_memo, encode_whole, has_added
from textflow.llm.words import chunk_runs

CAPACITY = 4096
END_ID = 1


class TightestFit:
    """Segment tree over the remaining capacities 0 .. ``top``: which of them
    some open bin has."""

    def __init__(self, top: int) -> None:
        self._size = 1 << top.bit_length()
        self._any = bytearray(2 * self._size)

    def set(self, room: int, present: bool) -> None:
        at = room + self._size
        self._any[at] = present
        at >>= 1
        while at:
            self._any[at] = self._any[2 * at] or self._any[2 * at + 1]
            at >>= 1

    def at_least(self, need: int) -> int | None:
        """The smallest capacity >= ``need`` that is present."""
        at = need + self._size
        if self._any[at]:
            return need
        # up to the first right sibling that holds one, then down its left
        while at > 1:
            if not at & 1 and self._any[at + 1]:
                at += 1
                while at < self._size:
                    at = 2 * at if self._any[2 * at] else 2 * at + 1
                return at - self._size
            at >>= 1
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY
         ) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[length]`` pieces: runs of (length,
    first number, first sequence, pieces per sequence, offset), in which the
    piece of number ``first + j`` goes to sequence ``j // per`` from the first
    one, ``j % per`` lengths behind the offset."""
    open_bins: dict[int, deque[tuple[int, int]]] = defaultdict(deque)
    tree = TightestFit(capacity)
    runs, n_bins = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            open_bins[room].append((first, n))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"no sequence holds a piece of {length}")
        number, left = 0, counts[length]
        while left:
            room = tree.at_least(length)
            if room is None:
                room, first = capacity, n_bins
                n = -(-left // (capacity // length))
                n_bins += n
            else:
                first, n = open_bins[room].popleft()
                if not open_bins[room]:
                    tree.set(room, False)
            per = room // length
            full = min(n, left // per)
            if full:
                runs.append((length, number, first, per, capacity - room))
                put(room - per * length, first, full)
            rest = min(left - full * per, per - 1) if full < n else 0
            number, left = number + full * per + rest, left - full * per - rest
            if rest:
                runs.append((length, number - rest, first + full, rest,
                             capacity - room))
                put(room - rest * length, first + full, 1)
            # what is not needed stays open
            put(room, first + full + (rest > 0), n - full - (rest > 0))
    return runs


PIECE = [
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.IntegerType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("nth", T.LongType()),
    T.StructField("ids", T.BinaryType()),
]


def _encode(tokenizer: str, capacity: int, end_id: int, like: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, memo = TaskContext.get().partitionId(), chunk_memo(tokenizer)
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            keys, texts = b.column(0), b.column(1)
            special = has_added(texts, tokenizer)
            for r in chunk_runs(texts, True, False):
                ids, off = memo.ids(r)
                row, piece, start, length, nth, body = [], [], [], [], [], []
                for i in range(r.rows):
                    own = ids[off[i]:off[i + 1]]
                    if special[r.first + i]:
                        own = encode_whole(tokenizer,
                                           texts[r.first + i].as_py())
                    own = np.append(np.asarray(own, "<u4"),
                                    np.array([end_id], "<u4"))
                    for k, lo in enumerate(range(0, len(own), capacity)):
                        cut = own[lo:lo + capacity]
                        row.append(r.first + i)
                        piece.append(k)
                        start.append(lo)
                        length.append(len(cut))
                        nth.append(int(seen[len(cut)]))
                        seen[len(cut)] += 1
                        body.append(cut.tobytes())
                yield pa.RecordBatch.from_arrays([
                    keys.take(pa.array(row, pa.int64())).cast(
                        like.field(0).type),
                    pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int32()),
                    pa.array(np.full(len(row), part, np.int32)),
                    pa.array(nth, pa.int64()), pa.array(body, pa.binary()),
                ], schema=like)

    return run


def encode_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
                  end_id: int = END_ID, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``id, piece, start, length, part, nth, ids`` of every piece, as a stage
    table; ``ids`` are little-endian unsigned 32-bit, ``nth`` counts the
    pieces of this length in partition ``part``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           *PIECE])
    return written(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
                   .mapInArrow(_encode(tokenizer, capacity, end_id,
                                       to_arrow_schema(schema)), schema),
                   "pieces")


def _place(runs, like: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = runs.value          # sorted by (length, first number)
        for b in batches:
            length = b.column("length").to_numpy().astype(np.int64)
            number = b.column("number").to_numpy()
            # the last run of this length that begins at or before the number
            at = np.empty(len(length), np.int64)
            for n in np.unique(length):
                mine = length == n
                lo, hi = np.searchsorted(table[0], [n, n + 1])
                at[mine] = lo + np.searchsorted(table[1][lo:hi],
                                                number[mine], "right") - 1
            j = number - table[1][at]
            yield pa.RecordBatch.from_arrays([
                *[b.column(f.name) for f in list(like)[:-2]],
                pa.array(table[2][at] + j // table[3][at], pa.int64()),
                pa.array(table[4][at] + j % table[3][at] * length,
                         pa.int64())], schema=like)

    return run


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The columns of ``pieces`` (``encode_pieces``) but ``part`` and ``nth``,
    with the ``sequence_id`` and ``offset`` of every piece.

    Only the columns that are used further on are read and shuffled."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = pieces.sparkSession
    per_part = written(pieces.groupBy("part", "length").agg(
        F.count(F.lit(1)).alias("n")), "lengths")
    # at most ``capacity`` rows
    counts = {r.length: r.n for r in per_part.groupBy("length").agg(
        F.sum("n").alias("n")).collect()}
    runs = plan(counts, capacity)
    table = np.array(runs, np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))].T.copy()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    base = per_part.select("part", "length", F.coalesce(
        F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = pieces.join(base, ["part", "length"]).withColumn(
        "number", F.col("base") + F.col("nth"))
    keep = [c for c in pieces.columns if c not in ("part", "nth")]
    numbered = numbered.select(*keep, "number")
    schema = T.StructType([*[pieces.schema[c] for c in keep],
                           T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return numbered.mapInArrow(
        _place(spark.sparkContext.broadcast(table), to_arrow_schema(schema)),
        schema)


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, n_tokens, ids`` of the packed sequences themselves: the
    ids of the pieces in the order of their offsets, at most ``capacity``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return (place(pieces, capacity).groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), parts.alias("p"))
        .select("sequence_id", "n_tokens", F.unhex(F.array_join(F.transform(
            "p", lambda x: F.hex(x["ids"])), "")).alias("ids")))


def op12_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from textflow.llm.stage import documents
    pieces = encode_pieces(documents(spark, sf_dir),
                           public_tokenizers.path("word_bpe_49k.json"))
    return place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
                 ).select(F.col("id").alias("doc_id"), "piece", "start",
                          F.col("length").cast("long").alias("length"),
                          "ids_crc32", "sequence_id", "offset")
