"""First-order HMM tagger estimated and decoded in Spark.

Estimation is counting: the previous tag by a block-wise lag (a long sentence
is spread over many tasks), then hash aggregations.

Decoding needs a sentence's tokens in order: one row per sentence, whose
tokens carry the few (tag, probability) pairs of their word.  The transition
matrix and the emissions of the pooled rare word are bounded by the tag set
and travel with the task.  Arrow batches of sentences are decoded together,
step t for all sentences that have a t-th token, with numpy arrays of fixed
size: time and memory are linear in the number of tokens.

Decode semantics follow the reference exactly:

* greedy: per token the arg-max over tags of ``trans(prev, t) * emit(t, w)``
  with the *predicted* previous tag (START at a sentence start); when every
  product is 0 the previous tag is kept if it has any outgoing transition,
  otherwise the first tag of the tag set;
* Viterbi: the first column is ``trans(START, t) * emit(t, w)`` for a known
  word and all zeros (hence reset to ones) for an unknown or rare one; each
  later cell is ``max_j2 (v[j2] * trans(j2, t)) * emit(t, w)`` with strict
  ``>`` (first tag wins ties, back-pointer 0 when nothing is positive); a
  column of zeros is reset to ones;
* a word counts as known when its training count is at least the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.operators.vocab import UNK, unk_map, word_count
from textflow.plans.sequence import neighbors

START = "START"


# ---- estimation -----------------------------------------------------------

def prev_tag(tagged: DataFrame, key: str = "sent_id", pos: str = "pos",
             tag: str = "tag") -> DataFrame:
    """``prev_tag`` = tag at ``pos - 1`` of the same sentence, or START.

    Positions must be dense (1, 2, ...); see ``plans.sequence.neighbors``.
    """
    n = neighbors(tagged, key, pos, [tag], [-1], keep=[
        c for c in tagged.columns if c not in (key, pos)])
    return (n.withColumnRenamed(f"{tag}_m1", "prev_tag")
            .withColumn("prev_tag", F.coalesce("prev_tag", F.lit(START))))


def tag_counts(tagged: DataFrame, key: str = "sent_id",
               tag: str = "tag") -> DataFrame:
    """K4: ``(tag, cnt)`` plus the START row (= number of sentences)."""
    per = tagged.groupBy(tag).agg(F.count(F.lit(1)).alias("cnt"))
    start = tagged.agg(F.lit(START).alias(tag),
                       F.count_distinct(key).alias("cnt"))
    return per.unionByName(start)


def transition_counts(tagged: DataFrame, **kw) -> DataFrame:
    """H1: ``(prev_tag, tag, cnt)``."""
    return prev_tag(tagged, **kw).groupBy("prev_tag", "tag").agg(
        F.count(F.lit(1)).alias("cnt"))


def transitions(tagged: DataFrame) -> DataFrame:
    """H2: ``(prev_tag, tag, prob)`` = count / count(prev_tag) (all tokens of
    the previous tag, including sentence-final ones; no smoothing)."""
    tc = tag_counts(tagged).select(F.col("tag").alias("prev_tag"),
                                   F.col("cnt").alias("n_prev"))
    return (transition_counts(tagged).join(tc, "prev_tag")
            .select("prev_tag", "tag",
                    (F.col("cnt") / F.col("n_prev")).alias("prob")))


def emissions(tagged: DataFrame, threshold: int = 2) -> DataFrame:
    """H3: ``(tag, word, prob)``; rare words are pooled as ``<unk>``."""
    vc = word_count(tagged, "word")
    keyed = unk_map(tagged, vc, "word", threshold)
    cnt = keyed.groupBy("tag", F.col("word_key").alias("word")).agg(
        F.count(F.lit(1)).alias("cnt"))
    tc = tag_counts(tagged).select("tag", F.col("cnt").alias("n_tag"))
    return cnt.join(tc, "tag").select(
        "tag", "word", (F.col("cnt") / F.col("n_tag")).alias("prob"))


def param_counts(trans: DataFrame, emis: DataFrame) -> DataFrame:
    """K9: number of transition and emission parameters."""
    n_emis = emis.agg(F.count(F.lit(1))).scalar()
    return trans.agg(F.count(F.lit(1)).alias("transition_params")).select(
        "transition_params", n_emis.alias("emission_params"))


# ---- decoding ---------------------------------------------------------------

def tag_list(tagged: DataFrame, tagset: Sequence[str] | None = None
             ) -> list[str]:
    """The tag set in tie-breaking order: a given list or the sorted distinct
    training tags."""
    if tagset is not None:
        return list(tagset)
    return sorted(r[0] for r in tagged.select("tag").distinct().collect())


def transition_matrix(trans: DataFrame, tags: Sequence[str]) -> np.ndarray:
    """``A[i][j]``: row 0 = START, row i = tag i-1; column j = tag j."""
    at = {t: i for i, t in enumerate(tags)}
    a = np.zeros((len(tags) + 1, len(tags)))
    for r in trans.collect():           # at most (tags + 1) * tags rows
        row = 0 if r["prev_tag"] == START else at.get(r["prev_tag"], -2) + 1
        if row >= 0 and r["tag"] in at:
            a[row, at[r["tag"]]] = r["prob"]
    return a


def unknown_emissions(emis: DataFrame, tags: Sequence[str]) -> np.ndarray:
    """Emissions of the pooled rare word, one per tag."""
    e = np.zeros(len(tags))
    for r in emis.filter(F.col("word") == UNK).collect():
        if r["tag"] in tags:
            e[list(tags).index(r["tag"])] = r["prob"]
    return e


def sentence_rows(tokens: DataFrame, vocab: DataFrame, emis: DataFrame,
                  tags: Sequence[str], threshold: int = 2,
                  key: str = "sent_id", pos: str = "pos", word: str = "word"
                  ) -> DataFrame:
    """One row per sentence: ``toks`` = position-sorted array of
    ``struct(pos, known, e)`` with ``e`` = array of ``struct(j, p)``.

    Only known words are joined to the emissions; a rare or unseen word has
    an empty ``e`` (its emissions are the same for all)."""
    keyed = unk_map(tokens, vocab, word, threshold)
    order = F.array(*[F.lit(t) for t in tags])
    known = emis.filter(F.col("word") != UNK).withColumn(
        "j", F.array_position(order, F.col("tag")) - 1).filter("j >= 0")
    rows = known.groupBy("word").agg(F.collect_list(F.struct(
        "j", F.col("prob").alias("p"))).alias("e"))
    k = keyed.select(key, pos, F.col("word_key").alias("_w"),
                     (F.col("word_key") != UNK).alias("known"))
    t = k.filter("known").join(rows.withColumnRenamed("word", "_w"), "_w",
                               "left")
    none = F.array().cast("array<struct<j:bigint,p:double>>")
    t = t.select(key, pos, "known", F.coalesce("e", none).alias("e"))
    t = t.unionByName(k.filter(~F.col("known")).select(
        key, pos, "known", none.alias("e")))
    return t.groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct(pos, "known", "e"))).alias("toks"))


def _chains(size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts longest first, sizes longest first, sentences per step)."""
    order = np.argsort(-size, kind="stable")
    start = (np.cumsum(size) - size)[order]
    size = size[order]
    longest = int(size[0]) if len(size) else 0
    return start, size, np.searchsorted(-size, -np.arange(longest), "left")


def greedy_paths(e: np.ndarray, known: np.ndarray, size: np.ndarray,
                 a: np.ndarray) -> np.ndarray:
    """Greedily chosen tag numbers of all tokens."""
    start, _, alive = _chains(size)
    path = np.zeros(len(e), np.int64)
    prev = np.full(len(start), -1)
    for t, n in enumerate(alive):
        at = start[:n] + t
        row = a[prev[:n] + 1]
        s = row * e[at]
        stay = np.where((prev[:n] >= 0) & (row.max(1) > 0), prev[:n], 0)
        path[at] = np.where(s.max(1) > 0, s.argmax(1), stay)
        prev = path[at]
    return path


def viterbi_paths(e: np.ndarray, known: np.ndarray, size: np.ndarray,
                  a: np.ndarray) -> np.ndarray:
    """Tag numbers of the Viterbi paths (see module notes)."""
    start, size, alive = _chains(size)
    back = np.zeros(e.shape, np.int32)
    v = np.zeros((len(start), e.shape[1]))
    for t, n in enumerate(alive):
        at = start[:n] + t
        if t == 0:
            v = np.where(known[at][:, None], a[0] * e[at], 0.0)
        else:
            cells = (v[:n, :, None] * a[1:]) * e[at][:, None, :]
            best = cells.max(1)
            back[at] = np.where(best > 0, cells.argmax(1), 0)
            v[:n] = best
        v[:n][~(v[:n].max(1) > 0)] = 1.0
    path = np.zeros(len(e), np.int64)
    if len(start):
        path[start + size - 1] = v.argmax(1)
    for t in range(len(alive) - 2, -1, -1):
        at = start[:alive[t + 1]] + t
        path[at] = back[at + 1, path[at + 1]]
    return path


def _decode_batches(method: str, tags: list[str], a: np.ndarray,
                    unk: np.ndarray, like: pa.Schema):
    paths = viterbi_paths if method == "viterbi" else greedy_paths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(tags, pa.string())
        for b in batches:
            toks = b.column(1)
            size = np.diff(toks.offsets.to_numpy())
            flat = toks.flatten()
            known = flat.field("known").to_numpy(zero_copy_only=False)
            pairs = flat.field("e")
            count = np.diff(pairs.offsets.to_numpy())
            jp = pairs.flatten()
            e = np.zeros((len(flat), len(tags)))
            e[np.repeat(np.arange(len(flat)), count),
              jp.field("j").to_numpy()] = jp.field("p").to_numpy()
            e[~known] = unk
            path = paths(e, known, size, a)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(np.repeat(np.arange(len(size)),
                                                    size))),
                flat.field(0), names.take(pa.array(path))], schema=like)

    return run


def decode(sentences: DataFrame, trans: DataFrame, emis: DataFrame,
           tags: Sequence[str], method: str = "viterbi",
           key: str = "sent_id", pos: str = "pos") -> DataFrame:
    """H4/H5: ``(sent_id, pos, pred)`` for every token."""
    from pyspark.sql.pandas.types import to_arrow_schema

    pos_type = sentences.schema["toks"].dataType.elementType[pos].dataType
    schema = T.StructType([
        T.StructField(key, sentences.schema[key].dataType),
        T.StructField(pos, pos_type), T.StructField("pred", T.StringType())])
    run = _decode_batches(method, list(tags), transition_matrix(trans, tags),
                          unknown_emissions(emis, tags),
                          to_arrow_schema(schema))
    return sentences.filter(F.size("toks") > 0).select(key, "toks"
                                                       ).mapInArrow(
        run, schema)


def tag_sentences(train: DataFrame, test: DataFrame, method: str = "viterbi",
                  tagset: Sequence[str] | None = None,
                  threshold: int = 2) -> DataFrame:
    """Estimate on ``train`` (sent_id, pos, word, tag) and decode ``test``
    (sent_id, pos, word[, tag])."""
    return tag_with_model(transitions(train), emissions(train, threshold),
                          word_count(train, "word"), test, method,
                          tag_list(train, tagset), threshold)


def tag_with_model(trans: DataFrame, emis: DataFrame, vocab: DataFrame,
                   test: DataFrame, method: str, tags: Sequence[str],
                   threshold: int = 2) -> DataFrame:
    """Decode with the three tables of a (re-read) model: transitions,
    emissions and the vocabulary ``(word, cnt)``."""
    sent = sentence_rows(test, vocab, emis, tags, threshold)
    return decode(sent, trans, emis, tags, method)
