"""Token sequences, batches, BIO spans and span F1.

Sentences are keyed ``(sent_id, pos)`` with dense positions.  Neighbour
access (context features, BIO boundaries) uses ``plans.sequence.neighbors``
and per-sentence numbering ``plans.ranking.block_rank``: windows over blocks
of positions, so no task holds a whole long sentence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.functions.constants import PAD_ID, PAD_LABEL
from textflow.plans.lineage import cut_lineage
from textflow.plans.ranking import block_rank, global_row_number
from textflow.plans.sequence import neighbors


def sentence_arrays(tokens: DataFrame, cols: Sequence[str],
                    key: str = "sent_id", pos: str = "pos") -> DataFrame:
    """One row per sentence with position-ordered arrays of ``cols``.

    A sentence's tokens are collected back into one row; sentences are the
    unit the consumers (batching, decoding) work on."""
    s = tokens.groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct(pos, *cols))).alias("_t"))
    def field(c):
        return F.transform("_t", lambda x: x[c]).alias(c)

    return s.select(key, F.size("_t").cast("long").alias("len"),
                    *[field(c) for c in cols])


def pad_batches(sent: DataFrame, batch_size: int = 16, key: str = "sent_id",
                ids: str = "ids", labels: str = "codes") -> DataFrame:
    """Batches of ``batch_size`` sentences in key order; ids padded with
    0 and labels with 9 up to the longest sentence of the batch."""
    r = global_row_number(sent, [key], "_rn")
    r = r.withColumn("batch", F.floor((F.col("_rn") - 1) / batch_size)
                     .cast("long"))
    longest = r.groupBy("batch").agg(F.max("len").alias("padded_len"))
    r = r.join(longest, "batch")
    pad = F.col("padded_len") - F.col("len")
    return r.select(
        key, "batch", "len", "padded_len",
        F.concat(ids, F.array_repeat(F.lit(PAD_ID).cast("long"),
                                     pad.cast("int"))).alias(ids),
        F.concat(labels, F.array_repeat(F.lit(PAD_LABEL), pad.cast("int")))
        .alias(labels))


def unpad(padded: DataFrame, col: str, key: str = "sent_id",
          length: str = "len", pos: str = "pos") -> DataFrame:
    """Keep the first ``len`` items and explode to ``(key, pos, col)``
    with positions from 1."""
    return padded.select(key, F.posexplode(F.slice(col, 1, F.col(length)
                                                   .cast("int")))
                         .alias("_p", col)).select(
        key, (F.col("_p") + 1).cast("long").alias(pos), col)


def context_features(tokens: DataFrame, cols: Sequence[str], k: int = 2,
                     key: str = "sent_id", pos: str = "pos") -> DataFrame:
    """Values of ``cols`` at ``pos - k .. pos + k`` (NULL outside)."""
    offs = [d for d in range(-k, k + 1) if d != 0]
    keep = [c for c in tokens.columns if c not in (key, pos)]
    return neighbors(tokens, key, pos, cols, offs, keep)


def _typ(c):
    return F.when(c.isNull() | (c == "O"), F.lit(None)).otherwise(
        F.regexp_extract(c, "^[BI]-(.*)$", 1))


def bio_spans(tokens: DataFrame, label: str | Sequence[str],
              key: str = "sent_id", pos: str = "pos") -> DataFrame:
    """``(sent_id, start, end, type)`` chunks of BIO labels.

    A chunk starts at ``B-x``, or at ``I-x`` after ``O``, after another type
    or at a sentence start; it ends before the next start or ``O``.  Starts
    and ends alternate along a sentence, so ranking the boundary rows of a
    sentence by ``(pos, start before end)`` pairs rank ``2k - 1`` with rank
    ``2k``: one distributed per-sentence numbering and one aggregation, no
    join.  With several label columns the result has a ``labels`` column
    naming the source column and all are chunked in the same pass.
    """
    labels = [label] if isinstance(label, str) else list(label)
    # one neighbour pass carries every label column; a token outside of every
    # chunk says as much as a missing one, so it is left out
    types = {c: f"_t_{c}" for c in labels}
    t = tokens.select(key, pos, *labels, F.col(pos).alias("_at"), *[
        _typ(F.col(c)).alias(t) for c, t in types.items()]).filter(
        F.coalesce(*types.values()).isNotNull())
    n = neighbors(t, key, pos, [*labels, *types.values(), "_at"], [-1, 1])
    before = F.col("_at") - F.col("_at_m1") <= 1
    after = F.col("_at_p1") - F.col("_at") <= 1
    kinds = []
    for c in labels:
        cur, nxt, typ = F.col(c), F.col(f"{c}_p1"), types[c]
        t_cur, t_prv, t_nxt = F.col(typ), F.when(
            before, F.col(f"{typ}_m1")), F.when(after, F.col(f"{typ}_p1"))
        is_start = t_cur.isNotNull() & (
            cur.startswith("B-") | t_prv.isNull() | (t_prv != t_cur))
        nxt_starts = t_nxt.isNotNull() & (
            nxt.startswith("B-") | t_cur.isNull() | (t_cur != t_nxt))
        nxt_cont = t_nxt.isNotNull() & ~nxt_starts
        is_end = t_cur.isNotNull() & ~nxt_cont
        # boundary rows only: a start (kind 0) and/or an end (kind 1)
        kinds += [F.when(edge, F.struct(
            F.lit(c).alias("labels"), F.lit(kind).alias("kind"),
            t_cur.alias("type"))) for kind, edge in ((0, is_start),
                                                     (1, is_end))]
    events = n.select(key, pos, F.explode(F.array_compact(F.array(*kinds)))
                      .alias("_e")).select(
        F.struct(key, F.col("_e.labels").alias("labels")).alias("_k"), pos,
        F.col("_e.kind").alias("_kind"), F.col("_e.type").alias("type"))
    # they are few, and the numbering reads them twice
    ranked = block_rank(cut_lineage(events), "_k", pos, [pos, "_kind"], "_r")
    spans = ranked.groupBy("_k", F.floor((F.col("_r") + 1) / 2).alias("_p")
                           ).agg(F.min(pos).alias("start"),
                                 F.max(pos).alias("end"),
                                 F.min("type").alias("type"))
    out = spans.select(F.col("_k")[key].alias(key), "start", "end", "type",
                       F.col("_k.labels").alias("labels"))
    return out if len(labels) > 1 else out.drop("labels")


def span_f1_tokens(tokens: DataFrame, gold_label: str = "gold",
                   pred_label: str = "pred", key: str = "sent_id",
                   pos: str = "pos") -> DataFrame:
    """E1 from one token table: gold and predicted chunks in one pass; the
    chunks are read four times, so they are written once."""
    sp = cut_lineage(bio_spans(tokens, [gold_label, pred_label], key, pos))
    gold = sp.filter(F.col("labels") == gold_label).drop("labels")
    pred = sp.filter(F.col("labels") == pred_label).drop("labels")
    return span_f1(gold, pred, tokens, key, gold_label, pred_label)


def span_f1(gold: DataFrame, pred: DataFrame, tokens: DataFrame | None = None,
            key: str = "sent_id", gold_label: str = "gold",
            pred_label: str = "pred") -> DataFrame:
    """Per type and overall (``type = 'ALL'``) span counts, precision,
    recall and F1 of exact (start, end, type) matches; the overall row
    carries token accuracy when ``tokens`` is given."""
    cols = [key, "start", "end", "type"]
    hit = gold.select(*cols).join(pred.select(*cols), cols).select(
        "type", F.lit(0).alias("g"), F.lit(0).alias("p"), F.lit(1).alias("c"))
    rows = (gold.select("type", F.lit(1).alias("g"), F.lit(0).alias("p"),
                        F.lit(0).alias("c"))
            .unionByName(pred.select("type", F.lit(0).alias("g"),
                                     F.lit(1).alias("p"), F.lit(0).alias("c")))
            .unionByName(hit))
    agg = rows.rollup("type").agg(
        F.sum("g").cast("long").alias("n_gold"),
        F.sum("p").cast("long").alias("n_pred"),
        F.sum("c").cast("long").alias("n_correct"))
    agg = agg.withColumn("type", F.coalesce("type", F.lit("ALL")))
    prec = F.when(F.col("n_pred") > 0, F.col("n_correct") / F.col("n_pred")
                  ).otherwise(0.0)
    rec = F.when(F.col("n_gold") > 0, F.col("n_correct") / F.col("n_gold")
                 ).otherwise(0.0)
    out = agg.select("type", "n_gold", "n_pred", "n_correct",
                     prec.alias("precision"), rec.alias("recall"))
    out = out.withColumn("f1", F.when(
        F.col("precision") + F.col("recall") > 0,
        2 * F.col("precision") * F.col("recall") /
        (F.col("precision") + F.col("recall"))).otherwise(0.0))
    if tokens is not None:
        acc = tokens.agg(F.avg(F.when(F.col(gold_label) == F.col(pred_label),
                                      1.0).otherwise(0.0))).scalar()
        out = out.withColumn("accuracy", F.when(F.col("type") == "ALL", acc))
    return out


def align_predictions(gold: DataFrame, pred: DataFrame,
                      key: Sequence[str] = ("sent_id", "pos")) -> DataFrame:
    """Predictions aligned to input tokens by position."""
    return gold.join(pred, list(key))


def eval_lines(tokens: DataFrame, gold: str = "gold", pred: str = "pred",
               word: str = "word", pos: str = "pos") -> DataFrame:
    """Scorer input line ``idx word gold pred`` per token."""
    return tokens.withColumn("line", F.concat_ws(
        " ", F.col(pos).cast("string"), word, gold, pred))


def class_weights(tokens: DataFrame, label: str) -> DataFrame:
    """K5: ``(label, n, freq, weight)`` with freq = n / total, weight = 1 /
    freq."""
    c = tokens.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = tokens.agg(F.count(F.lit(1))).scalar()
    return c.select(label, "n", (F.col("n") / total).alias("freq"),
                    (total / F.col("n")).alias("weight"))
