"""Seeded sampling, splitting and mini-batch ids.

The reference samples and splits without a seed.  Here every random choice
is the order of ``md5('<seed>:<key>')``, so the result is reproducible and
can be checked by an independent SQL engine.  Exact counts (``n`` per class,
``ceil(0.2 * n)`` test rows) are kept without a single-task window: see
``textflow.plans.ranking.smallest_by_hash``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.plans.ranking import global_row_number, smallest_by_hash
from textflow.sources.fixtures import SEED


def _seeded(cols: Sequence[str], seed: int) -> F.Column:
    parts = [F.lit(f"{seed}:")]
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(":"))
        parts.append(F.col(c).cast("string"))
    return F.md5(F.concat(*parts))


def balanced_sample(df: DataFrame, class_col: str, n: int,
                    key_cols: Sequence[str], tie_col: str,
                    seed: int = SEED) -> DataFrame:
    """``n`` rows of every class without replacement (all rows of a
    class that has fewer), chosen by seeded hash order."""
    h = df.withColumn("_h", _seeded(key_cols, seed))
    out = smallest_by_hash(h, "_h", tie_col, group_cols=[class_col], n=n)
    return out.drop("_h")


def hash_split_predicate(df: DataFrame, key: str, fraction: float,
                         seed: int = SEED, col: str | None = None):
    """The D1/D2 flag as a predicate on the key alone.

    The boundary ``(hash, key)`` of the ``ceil(fraction * n)`` smallest keys
    of ``df`` is one row: it is computed once, brought to the driver and used
    as a literal, so any table carrying the key (for example millions of
    per-document feature rows) is split by a filter, without joining flags
    back and without repeating the ranking in every plan.
    """
    h = df.select(F.col(key)).withColumn("_h", _seeded([key], seed))
    chosen = smallest_by_hash(h, "_h", key, fraction=fraction)
    bound = chosen.agg(F.max(F.struct("_h", key)).alias("b")).first()["b"]
    if bound is None:
        return F.lit(False)
    c = F.col(col or key)
    probe = F.struct(_seeded_col(c, seed).alias("_h"), c.alias(key))
    edge = F.struct(F.lit(bound["_h"]).alias("_h"), F.lit(bound[key]).cast(
        df.schema[key].dataType).alias(key))
    return F.coalesce(probe <= edge, F.lit(False))


def _seeded_col(c, seed: int):
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def hash_split(df: DataFrame, key: str, fraction: float, seed: int = SEED,
               name: str = "is_test") -> DataFrame:
    """Flag exactly ``ceil(fraction * n)`` rows (smallest seeded hash).

    See :func:`hash_split_predicate`: the flag is a plain comparison.
    """
    return df.withColumn(name, hash_split_predicate(df, key, fraction, seed))


def train_test_split(df: DataFrame, key: str, test_size: float = 0.2,
                     seed: int = SEED) -> DataFrame:
    """Adds ``split`` = 'test' for ``ceil(test_size * n)`` rows, else
    'train'."""
    s = hash_split(df, key, test_size, seed, "_t")
    return s.withColumn("split", F.when(F.col("_t"), "test")
                        .otherwise("train")).drop("_t")


def validation_split(df: DataFrame, key: str, val_size: float = 0.1,
                     seed: int = SEED + 1) -> DataFrame:
    """D2: 'val' for ``ceil(val_size * n)`` rows, else 'train'."""
    s = hash_split(df, key, val_size, seed, "_v")
    return s.withColumn("split", F.when(F.col("_v"), "val")
                        .otherwise("train")).drop("_v")


def minibatch_ids(df: DataFrame, key: str, batch_size: int,
                  seed: int = SEED) -> DataFrame:
    """Shuffled mini-batches: ``batch = (rank in seeded order - 1) //
    batch_size``, with ``slot`` the position inside the batch."""
    h = df.withColumn("_h", _seeded([key], seed))
    r = global_row_number(h, ["_h", key], "_rn")
    return (r.withColumn("batch", F.floor((F.col("_rn") - 1) / batch_size)
                         .cast("long"))
            .withColumn("slot", ((F.col("_rn") - 1) % batch_size).cast("long"))
            .drop("_h", "_rn"))
