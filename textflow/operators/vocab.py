"""Counts, thresholded and first-seen vocabularies, lookups.

Counting is a hash aggregation (map-side combine, so a hot word costs one
row per map task).  Vocabulary ids are exact global ranks computed with
``global_row_number`` (range-partitioned sort + per-partition offsets), never
a single-task window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.plans.ranking import global_row_number

UNK = "<unk>"


def word_count(tokens: DataFrame, word: str = "w") -> DataFrame:
    """K1: ``(word, cnt)``."""
    return tokens.groupBy(F.col(word).alias("word")).agg(
        F.count(F.lit(1)).alias("cnt"))


def vocab_threshold(tokens: DataFrame, word: str = "w",
                    order: tuple[str, str] = ("sent_id", "pos"),
                    threshold: int = 2) -> DataFrame:
    """K2: ``(word, id, cnt)``; words seen fewer than ``threshold`` times are
    pooled into ``<unk>`` (id 0, count = pooled occurrences); the others get
    ids 1.. by count descending, ties by first occurrence."""
    stats = tokens.groupBy(F.col(word).alias("word")).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min(F.struct(*order)).alias("first"))
    kept = stats.filter(F.col("cnt") >= threshold)
    ranked = global_row_number(kept, [F.desc("cnt"), F.col("first"),
                                      F.col("word")], "id")
    unk = stats.filter(F.col("cnt") < threshold).agg(
        F.lit(UNK).alias("word"), F.lit(0).cast("long").alias("id"),
        F.coalesce(F.sum("cnt"), F.lit(0)).cast("long").alias("cnt"))
    return unk.unionByName(ranked.select("word", "id", "cnt"))


def vocab_stats(tokens: DataFrame, word: str = "w",
                threshold: int = 2) -> DataFrame:
    """K3: ``(vocab_size, unk_total)``; size counts ``<unk>`` only when some
    word was pooled."""
    c = tokens.groupBy(word).agg(F.count(F.lit(1)).alias("cnt"))
    return c.agg(
        (F.count_if(F.col("cnt") >= threshold) +
         F.when(F.count_if(F.col("cnt") < threshold) > 0, 1).otherwise(0))
        .cast("long").alias("vocab_size"),
        F.coalesce(F.sum(F.when(F.col("cnt") < threshold, F.col("cnt"))),
                   F.lit(0)).cast("long").alias("unk_total"))


def vocab_first_seen(tokens: DataFrame, word: str = "word",
                     order: tuple[str, str] = ("sent_id", "pos")
                     ) -> DataFrame:
    """K6: ``(word, id)`` with ids 1.. in order of first appearance; id 0 is
    padding and ``V + 1`` the unknown word."""
    first = tokens.groupBy(F.col(word).alias("word")).agg(
        F.min(F.struct(*order)).alias("first"))
    return global_row_number(first, ["first", "word"], "id").select(
        "word", "id")


def unk_map(tokens: DataFrame, vocab_counts: DataFrame, word: str = "word",
            threshold: int = 2, name: str = "word_key") -> DataFrame:
    """``word_key`` = the word, or ``<unk>`` when unseen or rare.

    ``vocab_counts`` is ``(word, cnt)`` of the training data.
    """
    v = vocab_counts.select(F.col("word").alias("_vw"), F.col("cnt").alias("_vc"))
    j = tokens.join(v, tokens[word] == v["_vw"], "left")
    key = F.when(F.coalesce(F.col("_vc"), F.lit(0)) >= threshold,
                 F.col(word)).otherwise(F.lit(UNK))
    return j.withColumn(name, key).drop("_vw", "_vc")


def ids_with_unknown(tokens: DataFrame, vocab_ids: DataFrame,
                     word: str = "word", name: str = "wid") -> DataFrame:
    """J1 for the first-seen vocabulary: unknown words get ``V + 1``."""
    size = vocab_ids.agg(F.count(F.lit(1))).scalar()
    v = vocab_ids.select(F.col("word").alias("_vw"), F.col("id").alias("_id"))
    j = tokens.join(v, tokens[word] == v["_vw"], "left")
    return j.withColumn(name, F.coalesce(F.col("_id"), size + 1)).drop(
        "_vw", "_id")
