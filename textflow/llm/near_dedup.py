"""Near-duplicates by BagMinHash signatures, banding and exact checks.

Signatures.  A document is the multiset of its five-word shingles.  Each
shingle drives a Poisson process over (time, weight level); the process over
all levels is split level by level into the part up to the shingle's count
and the rest, which is dropped as soon as its next point is too late to
matter.  Every point falls on one of the signature's components, and a
component keeps the earliest point of all shingles: two documents agree on a
component with a probability equal to the weighted Jaccard similarity of
their discretised counts (counts up to 16 are exact, larger ones rounded
down by less than 7 %).  Points are drawn for whole batches of documents up
to a time by which all components have one, and on for the few documents
where some have none.

Search.  Documents with the same words are one class from the start.  The
classes' signatures are cut into bands; in every bucket of classes that agree
on a band, all are compared with the bucket's *centre* -- the class that shares
bands with most others -- by the exact overlap of the multisets.  Where this
leaves classes *alone*, not connected to their centre, the star -- all stars
whose centres are connected count as one -- is compared with its *hub*, the
multiset sum of a centre and a few more members: it holds nearly all that the star's classes
have in common, also where the original that they copy is lost.  What a class
has in common with the hub h is known then, and so is its *rest*, the shingles
that the hub lacks.  Whatever h is, classes x and y overlap by at most

    min(|x & h|, |y & h|) + |rest(x) & rest(y)|.

So a class that is alone can only be similar to a member of the star with
which it shares enough shingles of their rests, or to one so short that the
common part alone may be enough.  These meet by an equi-join on (star, shingle
of the first ones in a fixed order) or (star, size class); where few are looking, pairs are compared, and where
many are, they are a bucket of the next round with a centre of their own.  No
other pair can be similar, so every similar pair that shares a band ends up in
one component, though a group of n near copies costs about n comparisons.

Rows: null text counts as empty.  Texts of fewer than five words are one
shingle; texts without words are only equal to the same text.  Repeated rows
and null ids are ordinary members of their class; the largest id stays (of
repeated rows, one).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.llm.stage import written
from textflow.llm.words import (WORDS, Runs, mix, ranges, spread, uniform,
                                word_runs)

WORDS_PER_SHINGLE = 5
SIMILAR_NUM, SIMILAR_DEN = 4, 5         # similarity of 0.8 or more
BANDS, BAND_ROWS = 25, 5
COMPONENTS = BANDS * BAND_ROWS


def weight_levels(largest: float = 2.0 ** 40) -> np.ndarray:
    """0, 1, 2, ... 16, then about 1/16 more each time."""
    v = list(range(17))
    while v[-1] < largest:
        v.append(v[-1] + v[-1] // 16)
    return np.array(v, np.float64)


LEVELS = weight_levels()
_COEF = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                  0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def shingles(r: Runs) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, offsets of the rows into them)."""
    k = WORDS_PER_SHINGLE
    h = np.concatenate([r.hash, np.zeros(k, np.uint64)])
    g = np.zeros(len(r.hash), np.uint64)
    for i in range(k):
        g += h[i:i + len(r.hash)] * _COEF[i]
    g = mix(g)
    words = np.diff(r.ptr)
    count = np.maximum(words - k + 1, 0)
    first = r.ptr[:-1].copy()
    out = np.zeros(int(np.where(words > 0, np.maximum(count, 1), 0).sum()),
                   np.uint64)
    size = np.where(words > 0, np.maximum(count, 1), 0)
    off = np.concatenate([[0], np.cumsum(size)])
    out[ranges(off[:-1], count)] = g[ranges(first, count)]
    for i in np.flatnonzero((words > 0) & (words < k)):
        own = r.hash[r.ptr[i]:r.ptr[i + 1]]
        x = np.array([len(own)], np.uint64)
        for w in own:
            x = mix(x ^ w)
        out[off[i]] = x[0]
    return out, off


def _draw(d: np.ndarray, level: int, what: int) -> np.ndarray:
    salt = np.uint64((level * 0x9E3779B97F4A7C15 + what * 0xD6E8FEB86659FD93
                      + 0x632BE59BD9B4E019) & (2 ** 64 - 1))
    return mix(d ^ salt)


def _exponential(bits: np.ndarray, rate: float) -> np.ndarray:
    return -np.log(uniform(bits)) / rate


def _points(elem: np.ndarray, doc: np.ndarray, level: np.ndarray,
            limit: np.ndarray, sig: np.ndarray) -> None:
    """Lower ``sig`` by all points of the elements up to their document's
    time ``limit``."""
    m = sig.shape[1]
    flat = sig.ravel()
    top = LEVELS[-1]
    # first point of the process over all levels
    rest = _exponential(_draw(elem, 0, 1), top)
    at = np.arange(len(elem))
    step = 0
    while len(at):
        step += 1
        rate = LEVELS[step] - LEVELS[step - 1]
        above = top - LEVELS[step]
        d, x = elem[at], rest[at]
        # split the process above level step - 1 into this level and the rest
        own = uniform(_draw(d, step, 2)) * (rate + above) < rate
        mine = np.where(own, x, x + _exponential(_draw(d, step, 3), rate))
        if above > 0:
            rest[at] = np.where(
                own, x + _exponential(_draw(d, step, 4), above), x)
        # the points of this level
        live, t = at, mine
        seed = _draw(d, step, 5)
        while True:
            keep = t <= limit[doc[live]]
            if not keep.all():
                live, t, seed = live[keep], t[keep], seed[keep]
            if not len(live):
                break
            comp = (seed >> np.uint64(32)) % np.uint64(m)
            np.minimum.at(flat, doc[live] * m + comp.astype(np.int64), t)
            seed = mix(seed + np.uint64(0x9E3779B97F4A7C15))
            t = t + _exponential(seed, rate)
            seed = mix(seed)
        at = at[(level[at] > step)]
        at = at[rest[at] <= limit[doc[at]]]


def signatures(hashes: np.ndarray, off: np.ndarray,
               m: int = COMPONENTS) -> np.ndarray:
    """Rows x m earliest times; rows without shingles are infinite."""
    n = len(off) - 1
    sig = np.full((n, m), np.inf)
    doc = spread(np.diff(off))
    # distinct shingles of every document with their counts
    _, first, count = np.unique(
        mix(hashes ^ mix(doc.astype(np.uint64) + np.uint64(1))),
        return_index=True, return_counts=True)
    elem, doc = hashes[first], doc[first]
    level = np.searchsorted(LEVELS, count, "right") - 1
    weight = np.bincount(doc, LEVELS[level], minlength=n)
    live = weight > 0
    limit = np.zeros(n)
    limit[live] = m * (np.log(m) + 3.0) / weight[live]
    todo = np.ones(len(elem), bool)
    while todo.any():
        _points(elem[todo], doc[todo], level[todo], limit, sig)
        open_ = live & np.isinf(sig).any(1)
        sig[open_] = np.inf
        limit[open_] *= 2
        todo = open_[doc]
    return sig


def bands_of(sig: np.ndarray) -> np.ndarray:
    """Rows x bands 64-bit keys; a key also says which band it is."""
    bits = np.ascontiguousarray(sig).view(np.uint64)
    out = np.zeros((len(sig), BANDS), np.uint64)
    for b in range(BANDS):
        x = np.full(len(sig), b + 1, np.uint64)
        for i in range(BAND_ROWS):
            x = mix(x ^ bits[:, b * BAND_ROWS + i])
        out[:, b] = x
    return out.view(np.int64)


def _sign(text_col: str, like: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 33
        for b in batches:
            row = b.column(0)
            for r in word_runs(row.field(text_col), WORDS):
                h, off = shingles(r)
                n = np.diff(off)
                bands = bands_of(signatures(h, off))
                keys = []
                for i in range(r.rows):
                    own = r.hash[r.ptr[i]:r.ptr[i + 1]]
                    body = own.tobytes() if len(own) else b"-" + bytes(
                        r.raw[r.off[i]:r.off[i + 1]]).lower()
                    keys.append(hashlib.blake2b(body, digest_size=16)
                                .hexdigest())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(uid, uid + r.rows)),
                    pa.array(keys), pa.array(n.astype(np.int64)),
                    pa.array([x if k else [] for x, k in zip(
                        bands, n, strict=True)], pa.list_(pa.int64())).cast(
                            like.field("bands").type),
                    row.slice(r.first, r.rows).cast(like.field("row").type),
                ], schema=like)
                uid += r.rows

    return run


def sign(docs: DataFrame, text_col: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns])
                         .alias("row"))
    schema = T.StructType([
        T.StructField("uid", T.LongType()), T.StructField("key",
                                                          T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        packed.schema["row"]])
    return packed.mapInArrow(_sign(text_col, to_arrow_schema(schema)), schema)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]
            ) -> int:
    """Size of the intersection of two multisets (sorted values, counts)."""
    if not len(b[0]):
        return 0
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0]
    return int(np.minimum(a[1][same], b[1][at[same]]).sum())


def _bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for r in word_runs(texts, WORDS):
        h, off = shingles(r)
        for i in range(r.rows):
            out.append(np.unique(h[off[i]:off[i + 1]], return_counts=True))
    return out


_PAIR = T.StructType([
    T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("n_b", T.LongType()),
    T.StructField("both", T.LongType()),
    T.StructField("rest", T.ArrayType(T.LongType()))])
_SLICE = 256


def rest_of(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]
            ) -> np.ndarray:
    """What ``a`` holds more than ``b``, one hash for each time, in order."""
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    have = np.where(b[0][at] == a[0], b[1][at], 0) if len(b[0]) else 0
    more = np.maximum(a[1] - have, 0)
    times = ranges(np.zeros(len(more), np.int64), more).astype(np.uint64)
    return np.sort(mix(np.repeat(a[0], more) + times * _COEF[1]))


def _verify(with_rest: bool):
    """(a, b, n, n_b, text_a, text_b) -> (a, b, n, n_b, both, rest): their
    overlap, and the rest of ``a``."""
    schema = pa.schema([*((c, pa.int64()) for c in (
        "a", "b", "n", "n_b", "both")), ("rest", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, centre_bag = None, None
        for whole in batches:
            for lo in range(0, whole.num_rows, _SLICE):
                b = whole.slice(lo, _SLICE)
                ids_b = b.column(1).to_pylist()
                bags = _bags(b.column(4))
                new = [i for i, x in enumerate(ids_b)
                       if x != (ids_b[i - 1] if i else centre)]
                fresh = iter(_bags(b.column(5).take(pa.array(new,
                                                             pa.int64()))))
                start = set(new)
                both, rest = [], []
                for i, bag in enumerate(bags):
                    if i in start:
                        centre, centre_bag = ids_b[i], next(fresh)
                    both.append(overlap(bag, centre_bag))
                    rest.append(rest_of(bag, centre_bag).view(np.int64)
                                if with_rest else None)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:4], pa.array(both, pa.int64()),
                     pa.array(rest, pa.list_(pa.int64()))], schema=schema)

    return run


def _sized(df: DataFrame, rows: int, each: int | None = None) -> DataFrame:
    """``df``, made of about ``rows`` rows, in no more tasks than they need:
    a task for each shuffle partition costs more than the rows of a small
    table."""
    least = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(least, -(-rows // (each or TASK_ROWS))))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which holds ``rows`` rows at most, is broadcast if they are
    few."""
    return F.broadcast(df) if rows <= FEW_ROWS else df


def _are_stars(edges: DataFrame) -> bool:
    """Does every ``u`` have one ``v`` that is no ``u`` itself?"""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"),
                        F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(
        F.sum("up").alias("up"), F.max("down").alias("down")).filter(
        "up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(uid, comp) of every node of ``links`` (a, b) but the smallest uid of
    each component, which is ``comp``.

    Alternating large-star and small-star steps; both only keep, per node,
    the smallest neighbour, so a centre with any number of links is an
    aggregate and a join, which AQE splits.
    """
    edges = written(_sized(links.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v").distinct(), links.count()), "cc")
    while not _are_stars(edges):
        rows = 2 * edges.count()
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("m", "u").alias("m"))
        # large star: every larger neighbour is linked to the smallest
        large = (both.filter(F.col("v") > F.col("u"))
                 .join(_small(low, rows), "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        # small star: the node and its smaller neighbours to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(_small(low, rows), "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))))
        edges = written(_sized(small.filter(F.col("u") != F.col("v"))
                               .distinct(), rows), "cc")
    return edges.select(F.col("u").alias("uid"), F.col("v").alias("comp"))


def _similar(both: str, n: str, other: str):
    """Multisets of these sizes and this overlap are similar."""
    return (F.col(both) > 0) & (SIMILAR_DEN * F.col(both) >= SIMILAR_NUM * (
        F.col(n) + F.col(other) - F.col(both)))


def _may_be_similar(x: str, y: str):
    """By sizes, common parts and rests."""
    n = [F.col(f"{k}.n") for k in (x, y)]
    most = F.least(f"{x}.both", f"{y}.both") + F.least(f"{x}.more",
                                                       f"{y}.more")
    return (SIMILAR_DEN * F.least(*n) >= SIMILAR_NUM * F.greatest(*n)) & (
        SIMILAR_DEN * most >= SIMILAR_NUM * (n[0] + n[1] - most))


def _labels(links: DataFrame, nodes: int) -> DataFrame:
    """(uid, label): the smallest uid within two links of so many nodes at
    most, itself included.

    Equal labels mean connected; connected nodes may still differ, which
    costs a comparison and loses nothing."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        links.select("b", "a"))
    near = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("v"), F.least("m", "u").alias("m"))
    return both.join(_small(near, nodes), "v").groupBy("u").agg(F.min("m").alias("m")).select(
        F.col("u").alias("uid"), F.least("m", "u").alias("label"))


FEW, MORE = 64, 64       # so many may look for partners in a bucket directly,
#                         and how many times as many in each further round
SIZE_STEP = 1.05        # ratio of the size classes
FEW_PAIRS = 1 << 18     # so many pairs of ids (4 MB) are broadcast
FEW_ROWS = 1 << 15      # and so many rows of other tables (1 to 3 MB)
TASK_ROWS, TASK_TEXTS = 1 << 14, 1 << 8     # rows or pairs of texts of a task
HUB = 5                 # members of a star in its hub, besides the centre
SLOT, SLOTS = 1 << 18, 256      # hashes of a star in a slot; slots of a star
FOUND = ["h", "seekers", "a", "n", "both", "more", "label", "seeks"]
_FOUND = T.StructType([T.StructField(c, T.BooleanType() if c == "seeks" else
                                     T.LongType()) for c in FOUND])


def _size_class(n):
    return F.floor(F.log(F.greatest(n, F.lit(1))) / math.log(SIZE_STEP))


def _undecided(stars: DataFrame, rows: int) -> DataFrame:
    """``a, b, n, rank, label, alone``: the stars (with label_b) united by
    the label of their centre, now ``b``, where some member is ``alone``, not
    known to be connected to it."""
    united = stars.select(
        "a", F.col("label_b").alias("b"), "n", "rank", "label",
        (F.col("label") != F.col("label_b")).alias("alone")).distinct()
    united = written(_sized(united, rows), "united")
    mixed = united.filter("alone").select("b").distinct()
    return united.join(_small(mixed, rows), "b", "left_semi")


def _meetings(rows: pa.Table) -> pa.Table:
    """``FOUND`` of the members that meet in a hash of their lists ``hs``:
    hashes with a seeker and with classes not known to be connected, of those
    with the same members one."""
    hs = rows.column("hs").combine_chunks()
    row = pc.list_parent_indices(hs).to_numpy()
    h = pc.list_flatten(hs).to_numpy()
    order = np.argsort(h)
    h, row = h[order], row[order]
    start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    count = np.diff(np.append(start, len(h)))
    label = rows.column("label").to_numpy()[row]
    seeks = rows.column("seeks").to_numpy()[row]
    seekers = np.add.reduceat(seeks.astype(np.int64), start)
    useful = (seekers > 0) & (np.minimum.reduceat(label, start)
                              < np.maximum.reduceat(label, start))
    # hashes of one change have the same members, who need to meet once only
    who = mix(row.astype(np.uint64) + np.uint64(1))
    sets = np.stack([np.add.reduceat(who, start), np.add.reduceat(
        mix(who), start)], 1)
    once = np.zeros(len(start), bool)
    once[np.unique(sets, axis=0, return_index=True)[1]] = True
    kept = np.repeat(useful & once, count)
    found = rows.select(FOUND[2:]).take(pa.array(row[kept]))
    return pa.table([pa.array(h[kept]), pa.array(np.repeat(seekers, count)
                                                 [kept]),
                     *found.columns], FOUND)


def _refined(live: DataFrame) -> DataFrame:
    """``h, seekers, a, n, both, more, label, seeks`` of the finer buckets of
    members and hubs (a, b, n, both, rest, label, alone): who is alone seeks
    partners, in the buckets of its rest's shingles and of the sizes that its
    common part may be similar to.  Only buckets with a seeker and with
    classes that are not known to be connected."""
    cols = ["b", "a", "n", "both", "label"]
    whole = SIMILAR_DEN + SIMILAR_NUM
    # a pair has an alone member, and needs so many hashes common to its
    # rests; of sets that share r elements the least |set| - r + 1 share one.
    # What is needed follows from the partners' sizes, by class, and the most
    # that one of a class has in common with the hub (a bounded list)
    star = live.groupBy("b", _size_class(F.col("n")).alias("c")).agg(
        *(f(F.when(who, of)).alias(f"{name}_{what}")
          for what, who in (("any", F.lit(True)), ("only", F.col("alone")))
          for f, of, name in ((F.min, F.col("n"), "least"),
                              (F.max, F.col("both"), "both"),
                              (F.max, F.size("rest"), "rest"))),
        F.sum(F.size("rest")).alias("values")).groupBy("b").agg(
        F.sum("values").alias("total"), F.collect_list(F.struct("c", *(
            f"{name}_{what}" for what in ("any", "only")
            for name in ("least", "both", "rest")))).alias("sizes"))
    shortest = F.ceil(F.col("n") * SIMILAR_NUM / SIMILAR_DEN)
    tallest = F.floor(F.col("n") * SIMILAR_DEN / SIMILAR_NUM)

    def of(c: Column, name: str) -> Column:
        return F.when(F.col("alone"), c[f"{name}_any"]).otherwise(
            c[f"{name}_only"])

    def needed(c: Column) -> Column:
        return F.ceil((F.col("n") + F.greatest(of(c, "least"), shortest))
                      * SIMILAR_NUM / whole) - F.least(F.col("both"),
                                                       of(c, "both"))

    # a class with too short rests has no partner either
    partners = F.filter("sizes", lambda c: c["c"].between(
        _size_class(shortest) - 1, _size_class(tallest) + 1) & (
        F.col("alone") | c["both_only"].isNotNull()) & (
        needed(c) <= of(c, "rest")))
    need = F.coalesce(F.array_min(F.transform(partners, needed)),
                      F.size("rest") + 1)       # none: no partner at all
    first = F.slice("rest", 1, F.greatest(F.size("rest") + 1 - F.greatest(
        need, F.lit(1)), F.lit(0)).cast("int"))
    # the hashes of a star meet in slots, each some of the hashes of all members
    count = live.count()
    hashed = live.join(_small(star, count), "b").select(
        "b", *FOUND[2:5], (F.col("n") - F.col("both")).alias("more"), "label",
        F.col("alone").alias("seeks"), F.transform(
            first, lambda v: F.xxhash64("b", v, F.lit(0))).alias("hs"),
        F.least(F.ceil(F.col("total") / SLOT), F.lit(SLOTS)).alias("slots"))
    picked = hashed.select("*", F.explode(F.array_distinct(F.transform(
        "hs", lambda h: F.pmod(h, F.col("slots"))))).alias("slot"))
    by_rest = picked.withColumn("hs", F.filter("hs", lambda h: F.pmod(
        h, F.col("slots")) == F.col("slot"))).select(
        F.xxhash64("b", "slot").alias("g"), "hs", *FOUND[2:]).groupBy(
        "g").applyInArrow(_meetings, _FOUND)
    # similar by the common part alone: (both >= 4/9 of the two sizes)
    longest = F.floor(F.col("both") * whole / SIMILAR_NUM) - F.col("n")
    own = _size_class(F.col("n"))
    sized = live.filter(SIMILAR_DEN * F.col("both") >= SIMILAR_NUM
                        * F.col("n"))
    classes = F.when(F.col("alone") & (longest >= shortest), F.sequence(
        _size_class(shortest) - 1, _size_class(longest) + 1)).otherwise(
        F.array().cast("array<long>"))
    by_size = sized.select(*cols, classes.alias("c"), own.alias("own")).select(
        *cols, "c", F.explode(F.array_union("c", F.array("own")))
        .alias("value")).select(
        *cols, F.array_contains("c", F.col("value")).alias("seeks"), "value",
        F.lit(1).alias("kind"))
    rows = written(by_size.select(
        F.xxhash64("b", "value", "kind").alias("h"), "a", "n", "both",
        F.lit(0).cast("long").alias("more"), "label", "seeks"), "parts")
    useful = rows.groupBy("h").agg(
        F.sum(F.col("seeks").cast("int")).alias("seekers"),
        F.min("label").alias("lo"), F.max("label").alias("hi")).filter(
        "seekers > 0 and lo < hi").select("h", "seekers")
    sizes = rows.count()
    return _sized(by_rest.union(rows.join(_small(useful, sizes), "h").select(
        *FOUND)), count + sizes)


def find_links(signed: DataFrame, text_col: str) -> DataFrame | None:
    """(uid, comp) of the representatives that are similar to others."""
    reps = written(_sized(signed.groupBy("key").agg(F.min(F.struct(
        "uid", "n", "bands")).alias("rep")).select("rep.*"),
        signed.count()), "reps")
    # most buckets hold one class only: they go before anything is joined
    filed = reps.select("uid", F.explode("bands").alias("h"))
    sizes = filed.groupBy("h").agg(F.count(F.lit(1)).alias("size")
                                   ).filter("size > 1")
    shared = written(_sized(filed.join(sizes, "h"), reps.count()), "shared")
    filled = shared.count()
    if not filled:
        return None
    # a class's rank as a centre: how many others share bands with it
    ranks = written(_sized(shared.groupBy("uid").agg(F.sum("size").alias(
        "rank")), filled), "ranks")
    many = ranks.count()
    nodes = written(_sized(reps.select("uid", "n").join(_small(
        ranks, many), "uid"), many), "nodes")
    texts = written(signed.select(
        "uid", F.col("row").getField(text_col).alias("text")).join(
        _small(nodes, many), "uid"), "texts")
    text_a = texts.select(F.col("uid").alias("a"), "n",
                          F.col("text").alias("text_a"))
    text_b = texts.select(F.col("uid").alias("b"), F.col("n").alias("n_b"),
                          F.col("text").alias("text_b"))
    columns = ["a", "b", "n", "n_b", "text_a", "text_b"]

    def compared(pairs: DataFrame, rows: int) -> DataFrame:
        """The pairs (a, b), made of so many rows, with their overlap and
        sizes.

        The pairs are a stage table first: while they are few, they go to the
        texts, and only the texts that they name are shuffled."""
        pairs = written(_sized(pairs, rows), "found")
        named, count = text_b, pairs.count()
        if count <= FEW_PAIRS:
            named = text_b.join(F.broadcast(pairs.select("b")), "b",
                                "left_semi")
            pairs = F.broadcast(pairs)
        p = text_a.join(pairs, "a").join(named, "b").select(*columns)
        return written(_sized(p, count, TASK_TEXTS).mapInArrow(
            _verify(False), _PAIR).drop("rest"), "pairs")

    def with_hubs(live: DataFrame, rows: int) -> DataFrame:
        """Overlap with the star's hub, and the rest."""
        first = Window.partitionBy("b").orderBy(F.desc("rank"), "a")
        some = live.select("a", "b", "rank").withColumn(
            "r", F.row_number().over(first)).filter(F.col("r") <= HUB)
        some = some.select("b", F.explode(F.when(
            F.col("r") == 1, F.array("a", "b")).otherwise(
            F.array("a"))).alias("a"))
        # at most HUB + 1 texts
        hubs = text_a.join(_small(some, 2 * rows), "a").groupBy("b").agg(
            F.concat_ws("\n", F.collect_list("text_a")).alias("text_b"))
        p = text_a.join(_small(live.select("a", "b"), rows), "a").join(
            hubs, "b").select("a", "b", "n", F.lit(0).cast("long").alias(
                "n_b"), "text_a", "text_b")
        return _sized(p, rows, TASK_TEXTS).mapInArrow(
            _verify(True), _PAIR).drop("n", "n_b").join(
            _small(live.drop("rank"), rows), ["a", "b"])

    def similar(pairs: DataFrame) -> DataFrame:
        return pairs.filter(_similar("both", "n", "n_b")).select("a", "b")

    buckets, rank = shared.select("h", "uid"), nodes.select("uid", "rank")
    links, used, enough = None, None, FEW
    while True:
        ranked = buckets.join(_small(rank, many), "uid")
        if used is not None:
            ranked = ranked.join(_small(used, used.count()), "uid",
                                 "left_anti")
        centres = written(_sized(ranked.groupBy("h").agg(
            F.max(F.struct("rank", (-F.col("uid")).alias("neg"))).alias("top"))
            .select("h", (-F.col("top.neg")).alias("b")), filled), "centres")
        centre = _small(centres, centres.count())
        stars = compared(buckets.join(centre, "h").filter("uid <> b").select(
            F.col("uid").alias("a"), "b").distinct(), filled)
        links = similar(stars) if links is None else links.union(
            similar(stars))
        label = written(_sized(_labels(links, many), many), "labels").select(
            F.col("uid").alias("a"), "label")
        labels, compares = label.count(), stars.count()
        named = stars.join(_small(label, labels), "a", "left").join(
            _small(label.toDF("b", "label_b"), labels), "b", "left").join(
            _small(rank.toDF("a", "rank"), many), "a")
        live = written(_undecided(named.withColumn(
            "label", F.coalesce("label", "a")).withColumn(
            "label_b", F.coalesce("label_b", "b")), compares), "live")
        finer = written(_refined(written(with_hubs(live, live.count()),
                                         "rests")), "finer")
        filled = finer.count()
        few = finer.filter(F.col("seekers") <= enough)
        x, y = _small(few.filter("seeks"), filled).alias("x"), few.alias("y")
        pairs = y.join(x, (F.col("x.h") == F.col("y.h"))
                       & (F.col("x.label") != F.col("y.label"))
                       & ((F.col("x.a") < F.col("y.a")) | ~F.col("y.seeks"))
                       & _may_be_similar("x", "y")).select(
            F.least("x.a", "y.a").alias("a"),
            F.greatest("x.a", "y.a").alias("b"))
        if used is not None:
            # buckets of which every class has been a centre before
            stuck = buckets.join(centre, "h", "left_anti")
            pairs = pairs.union(stuck.toDF("h", "a").join(
                stuck.toDF("h", "b"), "h").filter("a < b").select("a", "b"))
        links = links.union(similar(compared(pairs.distinct(), filled)))
        buckets = finer.filter(F.col("seekers") > enough).select(
            "h", F.col("a").alias("uid"))
        if buckets.isEmpty():
            return components(links)
        mine = centres.select(F.col("b").alias("uid")).distinct()
        used = written(_sized(mine if used is None else used.union(
            mine).distinct(), many), "used")
        enough *= MORE


def near_groups(docs: DataFrame, id_col: str = "doc_id",
                text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(``uid, id, n_shingles, class_id, group_size, kept`` of every row of
    ``docs``; the signed table, whose ``row`` has all columns of ``docs``).
    ``class_id`` is the id of the row that stays."""
    signed = written(sign(docs, text_col), "signed")
    comp = find_links(signed, text_col)
    reps = signed.groupBy("key").agg(F.min("uid").alias("rep"))
    if comp is not None:
        reps = reps.join(comp.select(F.col("uid").alias("rep"), "comp"),
                         "rep", "left").select(
            "key", F.coalesce("comp", "rep").alias("cls"))
    else:
        reps = reps.select("key", F.col("rep").alias("cls"))
    ids = signed.select("uid", "key", F.col("n").alias("n_shingles"),
                        F.col("row").getField(id_col).alias("id"))
    count = signed.count()
    rows = written(_sized(ids.join(reps, "key").drop("key"), count), "classes")
    stays = rows.groupBy("cls").agg(
        F.max(F.struct("id", (-F.col("uid")).alias("neg"))).alias("top"),
        F.count(F.lit(1)).alias("group_size"))
    return _sized(rows.join(stays, "cls"), count).select(
        "uid", "id", "n_shingles", F.col("top.id").alias("class_id"),
        "group_size", (F.col("uid") == -F.col("top.neg")).alias("kept")), \
        signed


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, with all columns.

    The ids of those that go are a stage table of their own: its size is
    known, and while it is small no text is shuffled."""
    groups, signed = near_groups(docs, id_col, text_col)
    gone = written(groups.filter(~F.col("kept")).select("uid"), "gone")
    return signed.join(gone, "uid", "left_anti").select("row.*")


def op2_near_dedup(spark, sf_dir: str) -> DataFrame:
    from textflow.llm.stage import documents
    groups, _ = near_groups(documents(spark, sf_dir).select("doc_id", "text"))
    return groups.select(F.col("id").alias("doc_id"), "class_id",
                         "group_size", "kept", "n_shingles")
