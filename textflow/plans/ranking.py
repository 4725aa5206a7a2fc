"""Exact ranks and hash-ordered selections without a single-task window.

``row_number() over (order by ...)`` with no partition puts every row into
one task.  The two helpers here give the same numbers with work that is
spread over all partitions:

* :func:`global_row_number` -- range-partitioned sort, a position id per
  row, per-partition counts, prefix offsets over the (small, bounded by the
  partition count) count table.
* :func:`smallest_by_hash` -- "the n rows with the smallest md5 key per
  group" (seeded sampling and splitting).  Rows are bucketed by the first
  hex digits of the hash; bucket counts give, per group, the buckets that
  are wholly in, and only the single boundary bucket is ranked row by row.
  A group that holds a third of all rows is still spread over 16^5 buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textflow.plans.lineage import cut_lineage

_PART_SHIFT = 33  # monotonically_increasing_id = partition << 33 | row index


def global_row_number(df: DataFrame, order_cols: Sequence[Column | str],
                      name: str = "rn",
                      partition_cols: Sequence[str] = ()) -> DataFrame:
    """Add ``name`` = 1-based position of each row in the total order.

    Same numbers as ``row_number() over (partition by partition_cols order by
    order_cols)``, but a hot partition key is spread over many range
    partitions instead of one task.  ``order_cols`` must make the order total
    (add a unique tie-breaker).
    """
    g = list(partition_cols)
    ordered = df.orderBy(*g, *order_cols).withColumn(
        "_mid", F.monotonically_increasing_id())
    # freeze the position ids: they depend on partition layout, and the frame
    # is read twice below (counts and the numbering itself)
    ordered = cut_lineage(ordered)
    part = F.shiftright(F.col("_mid"), _PART_SHIFT).alias("_p")
    counts = (ordered.groupBy(part, *g)
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0")))
    w = (Window.partitionBy(*g) if g else Window.partitionBy()).orderBy(
        "_p").rowsBetween(Window.unboundedPreceding, -1)
    # one row per (range partition, key): partitions + keys rows in total
    offsets = counts.select("_p", *g, "_m0", F.coalesce(
        F.sum("_n").over(w), F.lit(0)).alias("_off"))
    if not g:
        # bounded by the partition count: safe to broadcast
        offsets = F.broadcast(offsets)
    out = ordered.withColumn("_p", F.shiftright(F.col("_mid"), _PART_SHIFT))
    out = out.join(offsets, on=["_p", *g])
    rn = F.col("_off") + (F.col("_mid") - F.col("_m0")) + 1
    return out.withColumn(name, rn.cast("long")).drop("_mid", "_p", "_off",
                                                      "_m0")


BLOCK = 8192


def block_rank(df: DataFrame, key: str, pos: str,
               order_cols: Sequence[Column | str], name: str = "rn",
               block: int = BLOCK) -> DataFrame:
    """``name`` = 1-based rank of each row within ``key`` by ``order_cols``,
    whose leading column must be the integer ``pos``.

    Rows are numbered inside blocks of ``block`` positions, so a key with a
    third of all rows is spread over many tasks; the offsets come from one
    small table with a row per (key, block).
    """
    b = df.withColumn("_blk", F.floor(F.col(pos) / block))
    per = b.groupBy(key, "_blk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_blk").rowsBetween(
        Window.unboundedPreceding, -1)
    off = per.select(key, "_blk", F.coalesce(F.sum("_n").over(before),
                                             F.lit(0)).alias("_off"))
    w = Window.partitionBy(key, "_blk").orderBy(*order_cols)
    out = b.withColumn("_in", F.row_number().over(w)).join(
        off, [key, "_blk"])
    return out.withColumn(name, (F.col("_off") + F.col("_in")).cast(
        "long")).drop("_blk", "_in", "_off")


def _bucket(hash_col: Column, digits: int) -> Column:
    return F.conv(F.substring(hash_col, 1, digits), 16, 10).cast("long")


def smallest_by_hash(df: DataFrame, hash_col: str, tie_col: str,
                     group_cols: Sequence[str] = (), n: int | None = None,
                     fraction: float | None = None, digits: int = 5,
                     rank_col: str | None = None) -> DataFrame:
    """Rows with the ``n`` smallest ``(hash_col, tie_col)`` per group.

    ``hash_col`` is a lower-case hex digest (``md5``).  Either a fixed ``n``
    or ``fraction`` (keep ``ceil(fraction * group size)``) is given.  When
    ``rank_col`` is set, the selected rows carry their exact 1-based rank.
    """
    if (n is None) == (fraction is None):
        raise ValueError("give exactly one of n and fraction")
    g = list(group_cols)
    b = df.withColumn("_b", _bucket(F.col(hash_col), digits))
    counts = b.groupBy(*g, "_b").agg(F.count(F.lit(1)).alias("_c"))
    wg = Window.partitionBy(*g) if g else Window.partitionBy()
    run = wg.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    # the count table has at most 16^digits rows per group
    counts = counts.withColumn("_cum", F.sum("_c").over(run))
    if n is not None:
        counts = counts.withColumn("_k", F.lit(n).cast("long"))
    else:
        if g:
            total = F.sum("_c").over(wg.rowsBetween(
                Window.unboundedPreceding, Window.unboundedFollowing))
        else:
            total = b.agg(F.count(F.lit(1))).scalar()
        counts = counts.withColumn("_k", F.ceil(F.lit(fraction) * total)
                                   .cast("long"))
    counts = counts.withColumn("_before", F.col("_cum") - F.col("_c"))
    chosen = counts.filter(F.col("_before") < F.col("_k")).select(
        *g, "_b", "_before", "_cum", "_k")
    joined = b.join(chosen, on=[*g, "_b"])
    whole = joined.filter(F.col("_cum") <= F.col("_k"))
    edge = joined.filter(F.col("_cum") > F.col("_k"))
    # only the one boundary bucket per group is ranked row by row
    wb = Window.partitionBy(*g, "_b").orderBy(F.col(hash_col), F.col(tie_col))
    edge = edge.withColumn("_r", F.row_number().over(wb)).filter(
        F.col("_before") + F.col("_r") <= F.col("_k"))
    if rank_col:
        wr = Window.partitionBy(*g, "_b").orderBy(F.col(hash_col),
                                                  F.col(tie_col))
        whole = whole.withColumn(
            rank_col, (F.col("_before") + F.row_number().over(wr)).cast("long"))
        edge = edge.withColumn(rank_col,
                               (F.col("_before") + F.col("_r")).cast("long"))
    edge = edge.drop("_r")
    out = whole.unionByName(edge)
    return out.drop("_b", "_before", "_cum", "_k")
