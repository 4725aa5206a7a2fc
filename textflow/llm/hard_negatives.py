"""Hard negatives by exact search on lists shared by clusters of anchors.

Scores are inner products of integer vectors.  Anchors of similar direction
form a cluster with a centre ``c`` and a radius, the largest angle ``r``
between a member and the centre.  For a candidate ``v`` at an angle ``t`` from
the centre no member ``a`` can score more than

    |a| |v| cos(max(0, t - r)),

so the candidates of a task are sorted by ``|v| cos(max(0, t - r))`` once for
a cluster, and every member walks this one list from its top, in segments
that are one matrix product for all members still walking.  A member stops as
soon as the bound of the next candidate lies below the score that it still
needs; ties go on, because a smaller id may follow.

Anchors are the query set.  They are ordered by cluster and taken in blocks of
at most ``BLOCK_CELLS`` components; each block is broadcast and meets all rows
of the table in two passes.  The first finds each anchor's positives, the
second walks again for the negatives, with the score bands that the positives
give.  Tasks return their own best rows per anchor and band, which are merged
by a grouped limit.  Cluster centres, and scores that an anchor surely reaches
and so need not walk below, come from samples of at most ``SAMPLE`` rows; they
change how long a walk is and never what it finds.

Rows without an id, label or vector, or with a component that is null or not
finite, take no part.  Shorter vectors count as padded with zeros.  Repeated
rows are rows of their own, as anchors and as candidates; ties are ordered by
id.  Scores are 64-bit integers and must fit them; components are cut at
+-2**50.  An anchor without positives, or a positive
without a row in its band, returns nothing; an empty table returns no rows.
Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.llm.stage import written
from textflow.plans.lineage import scratch_path
from textflow.plans.ranking import global_row_number

ANCHOR_EVERY = 100
POSITIVES, NEGATIVES = 5, 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
SCALE = 256
SAMPLE = 4096
MEMBERS = 16            # anchors of the sample for each cluster
MAX_CLUSTERS = 256
BLOCK_CELLS = 4 << 20   # components of one broadcast block of anchors
LIST_CELLS = 4 << 20    # components of one sorted list of candidates
FIRST_SEGMENT, LAST_SEGMENT = 128, 4096
NONE = np.iinfo(np.int64).min
_ANGLE_SLACK, _BOUND_SLACK = 1e-6, 1e-9


def matrix(lists: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of an Arrow list array, padded with zeros to one width."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    width = max(width, int(size.max(initial=0)), 1)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width)[None, :] < size[:, None]] = flat
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows; a float product is exact while no
    sum can reach 2**53."""
    def norm(x):
        return np.sqrt((x.astype(np.float64) ** 2).sum(1)).max(initial=0)

    if norm(a) * norm(b) < 2.0 ** 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(
            np.int64)
    return a @ b.T


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(directions, norms); a zero vector has the zero direction."""
    x = x.astype(np.float64)
    norm = np.sqrt((x ** 2).sum(1))
    return x / np.where(norm > 0, norm, 1)[:, None], norm


def centres(sample: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Directions of the clusters of a bounded sample of anchors."""
    d, norm = unit(sample)
    d = d[norm > 0]
    k = min(MAX_CLUSTERS, -(-len(d) // MEMBERS))
    if not k:
        return np.zeros((1, sample.shape[1]))
    c = d[:: max(1, len(d) // k)][:k].copy()
    for _ in range(rounds):
        own = (d @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, own, d)
        moved, length = unit(total)
        c = np.where(length[:, None] > 0, moved, c)
    return c


@dataclass
class Block:
    """Anchors of one broadcast, and what each of them still looks for."""

    uid: np.ndarray
    label: np.ndarray
    vec: np.ndarray
    cluster: np.ndarray
    centre: np.ndarray          # of the clusters
    #: bands x anchors: scores to look for, ends included
    low: np.ndarray = field(default=None)
    high: np.ndarray = field(default=None)

    def __post_init__(self) -> None:
        d, self.norm = unit(self.vec)
        self.present = np.unique(self.cluster)
        self.radius = {}
        for k in self.present:
            mine = d[(self.cluster == k) & (self.norm > 0)]
            cos = np.clip(mine @ self.centre[k], -1, 1)
            self.radius[k] = float(np.arccos(cos).max(initial=0))


class Tops:
    """The best rows per (band, anchor): score, then smaller id."""

    def __init__(self, bands: int, anchors: int, keep: int,
                 floor: np.ndarray) -> None:
        self.keep = keep
        self.rows: dict[tuple[int, int], np.ndarray] = {}
        # a row below this is not among the best ``keep``
        self.floor = floor.copy()

    def add(self, band: int, anchor: int, score: np.ndarray, ident: np.ndarray,
            uid: np.ndarray) -> None:
        new = np.stack([score, ident, uid])
        old = self.rows.get((band, anchor))
        if old is not None:
            new = np.concatenate([old, new], 1)
        if new.shape[1] > self.keep:
            # ties of the last score stay in until ids decide
            least = np.partition(new[0], -self.keep)[-self.keep]
            new = new[:, new[0] >= least]
            new = new[:, np.lexsort((new[2], new[1], -new[0]))[:self.keep]]
        self.rows[band, anchor] = new
        if new.shape[1] == self.keep:
            self.floor[band, anchor] = max(self.floor[band, anchor],
                                           int(new[0].min()))


def walk(block: Block, tops: Tops, ident: np.ndarray, uid: np.ndarray,
         label: np.ndarray, vec: np.ndarray, same_label: bool) -> int:
    """Let all anchors walk the lists of these candidates; returns the number
    of scores that were computed."""
    d, norm = unit(vec)
    cos = np.clip(d @ block.centre.T, -1, 1)
    work = 0
    for k in block.present:
        angle = np.maximum(np.arccos(cos[:, k]) - block.radius[k]
                           - _ANGLE_SLACK, 0)
        bound = norm * (np.cos(angle) + _BOUND_SLACK)
        order = np.argsort(-bound, kind="stable")
        bound = bound[order]
        live = np.flatnonzero(block.cluster == k)
        live = live[(block.low[:, live] <= block.high[:, live]).any(0)]
        at, step = 0, FIRST_SEGMENT
        while at < len(order) and len(live):
            # certified: nothing from here on reaches a score still needed
            open_ = block.low[:, live] <= block.high[:, live]
            need = np.where(open_, tops.floor[:, live],
                            np.iinfo(np.int64).max).min(0)
            live = live[bound[at] * block.norm[live] >= need]
            if not len(live):
                break
            need = np.where(
                block.low[:, live] <= block.high[:, live],
                tops.floor[:, live], np.iinfo(np.int64).max).min(0)
            seg = order[at:at + step]
            found = scores(block.vec[live], vec[seg])
            work += found.size
            fits = ((label[seg][None, :] == block.label[live][:, None])
                    == same_label)
            fits &= found >= need[:, None]
            fits &= found <= block.high[:, live].max(0)[:, None]
            if same_label:
                fits &= uid[seg][None, :] != block.uid[live][:, None]
            for i in np.flatnonzero(fits.any(1)):
                a, own = int(live[i]), np.flatnonzero(fits[i])
                s = found[i, own]
                for band in range(len(block.low)):
                    take = ((s >= tops.floor[band, a])
                            & (s <= block.high[band, a]))
                    if take.any():
                        rows = seg[own[take]]
                        tops.add(band, a, s[take], ident[rows], uid[rows])
            at += step
            step = min(2 * step, LAST_SEGMENT)
    return work


_FOUND = T.StructType([
    T.StructField("a_uid", T.LongType()), T.StructField("band",
                                                        T.IntegerType()),
    T.StructField("score", T.LongType()), T.StructField("id", T.LongType()),
    T.StructField("uid", T.LongType())])


def _search(sent, keep: int, same_label: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, floor = sent.value
        tops = Tops(*block.low.shape, keep, floor)
        width = block.vec.shape[1]
        room = max(1, LIST_CELLS // width)
        held, n = [], 0

        def flush():
            t = pa.Table.from_batches(held)
            walk(block, tops, *(t[c].to_numpy() for c in (
                "id", "uid", "label")), matrix(t["q"], width), same_label)

        for b in batches:
            for lo in range(0, b.num_rows, room):
                held.append(b.slice(lo, room))
                n += held[-1].num_rows
                if n >= room:
                    flush()
                    held, n = [], 0
        if n:
            flush()
        for (band, a), rows in tops.rows.items():
            m = rows.shape[1]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(m, block.uid[a])),
                pa.array(np.full(m, band, np.int32)),
                *(pa.array(r) for r in rows)],
                names=["a_uid", "band", "score", "id", "uid"])

    return run


def _best(vectors: DataFrame, block: Block, floor: np.ndarray, keep: int,
          same_label: bool) -> DataFrame:
    """``a_uid, band, rank, id, score`` of the best rows of the table."""
    spark = vectors.sparkSession
    sent = spark.sparkContext.broadcast((block, floor))
    found = vectors.mapInArrow(_search(sent, keep, same_label), _FOUND)
    w = Window.partitionBy("a_uid", "band").orderBy(F.desc("score"), "id",
                                                    "uid")
    return found.withColumn("rank", F.row_number().over(w)).filter(
        F.col("rank") <= keep).select("a_uid", "band", "rank", "id", "score")


def prepared(vectors: DataFrame, id_col: str = "vec_id",
             vec_col: str = "embedding", label_col: str = "label",
             scale: int = SCALE) -> DataFrame:
    """``uid, id, label, q`` of the rows that take part, as a stage table;
    ``q`` are the integer components."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                          F.col(f"`{label_col}`").cast("long").alias("label"),
                          F.col(f"`{vec_col}`").cast("array<double>")
                          .alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < float("inf")))
    top = float(1 << 50)
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull()
                       & F.col("v").isNotNull()).filter(finite)
    return written(rows.select(
        F.monotonically_increasing_id().alias("uid"), "id", "label",
        F.transform("v", lambda x: F.floor(F.least(F.greatest(
            F.lit(float(scale)) * x, F.lit(-top)), F.lit(top)))).alias("q")),
        "vectors")


def _assign(centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, _ = unit(matrix(b.column(3), centre.shape[1]))
            own = (d @ centre.T).argmax(1) if len(d) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(own.astype(np.int32))],
                names=[*b.schema.names, "cluster"])

    return run


def _sampled(rows: DataFrame) -> pa.Table:
    """At most ``SAMPLE`` rows, by a hash of their number."""
    return rows.orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).toArrow()


def _reached(block: Block, sample: pa.Table, keep: int, same_label: bool
             ) -> np.ndarray:
    """Scores (bands x anchors) that the best ``keep`` rows surely reach: the
    band's low end, or more where the sample has enough rows."""
    floor = block.low.copy()
    if not sample.num_rows:
        return floor
    tops = Tops(*block.low.shape, keep, floor)
    walk(block, tops, *(sample[c].to_numpy() for c in ("id", "uid", "label")),
         matrix(sample["q"], block.vec.shape[1]), same_label)
    return tops.floor


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id",
                   vec_col: str = "embedding", label_col: str = "label",
                   anchor_every: int = ANCHOR_EVERY) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for each anchor (id divisible by ``anchor_every``) and
    each of its ``POSITIVES`` best rows of the same label, the best
    ``NEGATIVES`` rows of other labels whose score lies between
    ``LOW_PERCENT`` and ``HIGH_PERCENT`` of the positive's."""
    spark = vectors.sparkSession
    rows = prepared(vectors, id_col, vec_col, label_col)
    anchors = rows.filter(F.col("id") % anchor_every == 0)
    out_type = ("anchor_id long, positive_id long, rank int, negative_id "
                "long, positive_score long, negative_score long")
    size = rows.agg(F.max(F.size("q"))).first()[0]
    sample = _sampled(anchors)
    if not sample.num_rows:
        return spark.createDataFrame([], out_type)
    width = max(int(size), 1)
    centre = centres(matrix(sample["q"], width))
    numbered = anchors.mapInArrow(_assign(centre), T.StructType(
        [*anchors.schema.fields, T.StructField("cluster", T.IntegerType())]))
    per = max(1, BLOCK_CELLS // width)
    anchors = written(global_row_number(
        numbered, ["cluster", "uid"], "nth").withColumn(
            "block", F.floor((F.col("nth") - 1) / per)), "anchors")
    blocks = anchors.agg(F.max("block")).first()[0] + 1
    sample = _sampled(rows)
    pos_path = scratch_path(spark, "positives")
    neg_path = scratch_path(spark, "negatives")
    for k in range(blocks):
        t = anchors.filter(F.col("block") == k).toArrow()
        block = Block(*(t[c].to_numpy() for c in ("uid", "label")),
                      matrix(t["q"], width), t["cluster"].to_numpy(), centre)
        shape = (1, t.num_rows)
        block.low = np.full(shape, NONE)
        block.high = np.full(shape, np.iinfo(np.int64).max)
        best = _best(rows, block, _reached(block, sample, POSITIVES, True),
                     POSITIVES, True)
        best.select("a_uid", (F.col("rank") - 1).alias("band"),
                    F.col("id").alias("positive_id"),
                    F.col("score").alias("positive_score"),
                    F.lit(k).alias("block")).write.mode("append").parquet(
                        pos_path)
        # at most POSITIVES rows for each anchor of the block
        p = spark.read.parquet(pos_path).filter(F.col("block") == k).select(
            "a_uid", "band", "positive_score").toArrow()
        by_uid = np.argsort(block.uid)
        at = by_uid[np.searchsorted(block.uid[by_uid],
                                    p["a_uid"].to_numpy())]
        score = p["positive_score"].to_numpy()
        block.low = np.ones((POSITIVES, t.num_rows), np.int64)
        block.high = np.zeros((POSITIVES, t.num_rows), np.int64)
        band = p["band"].to_numpy()
        # whole scores s with LOW * p <= 100 s <= HIGH * p
        block.low[band, at] = -(-LOW_PERCENT * score // 100)
        block.high[band, at] = HIGH_PERCENT * score // 100
        best = _best(rows, block, _reached(block, sample, NEGATIVES, False),
                     NEGATIVES, False)
        best.write.mode("append").parquet(neg_path)
    names = anchors.select(F.col("uid").alias("a_uid"),
                           F.col("id").alias("anchor_id"))
    pos = spark.read.parquet(pos_path).drop("block").join(names, "a_uid")
    return spark.read.parquet(neg_path).join(pos, ["a_uid", "band"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    from textflow.llm.stage import documents
    rows = documents(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10
                   ).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))
