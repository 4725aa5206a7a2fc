"""Neighbour access inside sequences without a task per sequence.

``lag``/``lead`` over ``partition by sent_id order by pos`` sends a whole
sentence to one task.  Here a sentence is cut into blocks of positions; the
few rows next to a block's edge are copied into the neighbouring block, and
``lag``/``lead`` run inside blocks: one shuffle of one copy of every row, and
a sentence of any length is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 8192


def _suffix(d: int) -> str:
    return f"p{d}" if d > 0 else f"m{-d}"


def neighbors(df: DataFrame, key: str, pos: str, cols: Sequence[str],
              offsets: Sequence[int], keep: Sequence[str] = (),
              block: int = BLOCK) -> DataFrame:
    """Add ``<col>_m1`` (value at ``pos - 1``), ``<col>_p2`` (at ``pos + 2``)
    ... for every col and offset; NULL beyond the sentence.

    ``keep`` lists other columns of the row itself to carry along.
    Positions must be dense integers within each key, and offsets smaller
    than a block.
    """
    offs = [d for d in offsets if d != 0]
    back = max([0, *(-d for d in offs)])     # rows needed before a block
    ahead = max([0, *offs])                  # and after it
    payload = list(dict.fromkeys([*cols, *keep]))
    blk = F.floor(F.col(pos) / block)
    slot = F.pmod(F.col(pos), F.lit(block))
    places = F.array_compact(F.array(
        F.lit(0),
        F.when(slot >= block - back, F.lit(1)),     # seen from the next block
        F.when(slot < ahead, F.lit(-1))))           # and from the one before
    x = df.select(key, pos, *payload, blk.alias("_blk"),
                  F.explode(places).alias("_move"))
    x = x.withColumn("_blk", F.col("_blk") + F.col("_move"))
    w = Window.partitionBy(key, "_blk").orderBy(pos)
    out = [F.lag(c, -d).over(w).alias(f"{c}_{_suffix(d)}") if d < 0
           else F.lead(c, d).over(w).alias(f"{c}_{_suffix(d)}")
           for d in offs for c in cols]
    return (x.select(key, pos, *payload, "_move", *out)
            .filter(F.col("_move") == 0).drop("_move"))
