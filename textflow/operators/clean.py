"""P1-P10 row hygiene and T6-T16 text operators that need more than a column.

Per-row text work is a projection (``textflow.functions.text``).  Work that
depends on a word list is done once per *distinct word* and joined back
(lemmas), or as a per-row array filter when the list is small and fixed
(stop words), so nothing per token needs a shuffle unless the list is
data-sized (vector vocabulary: a semi join, AQE-split when skewed).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.functions.constants import LEMMA_RULES, NER_LABELS, STOP_WORDS
from textflow.plans.lineage import cut_lineage


# ---- P1-P10 ---------------------------------------------------------------

def drop_nulls(df: DataFrame) -> DataFrame:
    """P1."""
    return df.dropna("any")


def dedup_rows(df: DataFrame) -> DataFrame:
    """One row per full-row value."""
    return df.dropDuplicates()


def class_frames(df: DataFrame, rating: str = "star_rating"
                 ) -> list[DataFrame]:
    """P5: the three rating predicates ``<= 2``, ``= 3``, ``>= 4``."""
    r = F.col(rating).try_cast("int")
    return [df.filter(r <= 2), df.filter(r == 3), df.filter(r >= 4)]


def union_classes(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union of the class frames."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def drop_empty(df: DataFrame, text: str) -> DataFrame:
    """Empty cleaned text counts as missing."""
    return df.filter(F.length(F.col(text)) > 0)


def label_table(spark) -> DataFrame:
    """P10: the fixed label code table (9 rows)."""
    return spark.createDataFrame(NER_LABELS, "label string, code int")


def encode_labels(df: DataFrame, label: str, code: str = "code") -> DataFrame:
    """P10 encode: broadcast join on the fixed 9-row code table."""
    t = label_table(df.sparkSession).withColumnRenamed("code", code)
    return df.join(F.broadcast(t), df[label] == t["label"], "left").drop(
        t["label"])


def decode_labels(df: DataFrame, code: str, label: str = "label") -> DataFrame:
    """P10 decode."""
    t = label_table(df.sparkSession).withColumnRenamed("label", label)
    return df.join(F.broadcast(t), df[code] == t["code"], "left").drop(
        t["code"])


# ---- T10-T15 ---------------------------------------------------------------

def stopword_tokens(tokens: DataFrame, word: str = "w",
                    stop: Sequence[str] = STOP_WORDS) -> DataFrame:
    """T11 on token rows: broadcast anti join on the fixed stop list."""
    st = tokens.sparkSession.createDataFrame([(s,) for s in sorted(set(stop))],
                                             f"{word} string")
    return tokens.join(F.broadcast(st), word, "left_anti")


def lemma_map(vocab: DataFrame, word: str = "w",
              rules: Sequence[tuple[str, str, str]] = LEMMA_RULES
              ) -> DataFrame:
    """``(w, lemma)`` for every distinct word of ``vocab``.

    Each suffix rule, tried in order, proposes ``stem + replacement``; the
    first proposal that is itself a known word wins, otherwise the word is
    its own lemma.  Runs once per distinct word (the reference tags words
    in isolation, so per-word and per-token results are the same).
    """
    words = vocab.select(F.col(word).alias("_w")).distinct()
    hit = changed_lemmas(words, rules)
    return (words.join(hit, "_w", "left")
            .select(F.col("_w").alias(word),
                    F.coalesce("lemma", "_w").alias("lemma")))


def changed_lemmas(words: DataFrame,
                   rules: Sequence[tuple[str, str, str]] = LEMMA_RULES
                   ) -> DataFrame:
    """``(_w, lemma)`` of the words whose lemma is another word."""
    rule_arr = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(s).alias("s"),
                                  F.lit(r).alias("r"))
                         for i, (_, s, r) in enumerate(rules)])
    cand = (words.select("_w", F.explode(rule_arr).alias("k"))
            .filter(F.col("_w").endswith(F.col("k.s")) &
                    (F.length("_w") > F.length("k.s")))
            .select("_w", F.col("k.i").alias("i"), F.concat(
                F.expr("substring(_w, 1, length(_w) - length(k.s))"),
                F.col("k.r")).alias("cand"))
            .filter(F.col("cand") != F.col("_w")))
    known = words.select(F.col("_w").alias("cand"))
    return (cand.join(known, "cand", "left_semi").groupBy("_w")
            .agg(F.min_by("cand", "i").alias("lemma")))


def lemmatize_tokens(tokens: DataFrame, lemmas: DataFrame,
                     word: str = "w") -> DataFrame:
    """Replace each token by its lemma (join on the word; AQE splits hot
    words or broadcasts a small map)."""
    return (tokens.join(lemmas, word, "left")
            .withColumn(word, F.coalesce("lemma", word)).drop("lemma"))


def rebuild_text(tokens: DataFrame, key: str = "doc_id", pos: str = "pos",
                 word: str = "w", name: str = "body") -> DataFrame:
    """Tokens back to one string per document, in position order.

    A document's tokens came from one row, so collecting them back per
    document never grows beyond the input row.
    """
    return tokens.groupBy(key).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(pos, word))),
        lambda s: s[word]), " ").alias(name))


def vocab_filter(tokens: DataFrame, vocab: DataFrame, word: str = "w",
                 vocab_word: str = "word") -> DataFrame:
    """Keep tokens that have a vector (left semi join)."""
    v = vocab.select(F.col(vocab_word).alias(word))
    return tokens.join(v, word, "left_semi")


def preprocess_tokens(tokens: DataFrame, word: str = "w",
                      source: DataFrame | None = None) -> DataFrame:
    """Stop words out, then lemmas; lemma vocabulary = all words.  Only
    words with another lemma take part in the join; while they are a small
    stage table, Spark sends them to the tokens.  ``source`` has the same
    tokens in any partitions, if that is cheaper to count."""
    kept = stopword_tokens(tokens, word)
    words = cut_lineage((source or tokens).select(F.col(word).alias("_w"))
                        .distinct())
    return lemmatize_tokens(kept, cut_lineage(changed_lemmas(words))
                            .withColumnRenamed("_w", word), word)
