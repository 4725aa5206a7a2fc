"""Derived input tables (FIXTURES.md part B) built from the driver tables.

The reference reads review pickles and tab/space separated token files that
are not available; these functions derive tables of the same shape from the
given parquet tables with deterministic rules, so that every query's work
grows with the input.  Each has a DuckDB twin in
``textflow.checks.oracle_sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textflow.functions.text import clean_text, split_words
from textflow.plans.ranking import block_rank, global_row_number
from textflow.plans.sequence import neighbors

SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str,
          spread_rows: bool = True) -> DataFrame:
    """Parquet table, spread over the cluster when the scan is narrower.

    A file with a single row group scans as one task; the per-document
    work after it (regexes, n-grams) would then run on one core.  Large
    inputs already scan as many partitions and are left untouched.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if spread_rows else df


def spread(df: DataFrame) -> DataFrame:
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par:
        return df.repartition(par)
    return df


def seeded_md5(*cols) -> F.Column:
    """``md5('42:' || a || ':' || b ...)`` -- the seeded random order."""
    parts = [F.lit(f"{SEED}:")]
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(":"))
        parts.append(F.col(c).cast("string") if isinstance(c, str)
                     else c.cast("string"))
    return F.md5(F.concat(*parts))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: (star_rating STRING, review_body STRING) with nulls and copies.

    The rating is ``1 + n_chars % 5`` so that the exact text copies present in
    ``documents`` are exact row copies; a few values are nulled.
    """
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.when(F.col("doc_id") % 97 == 0, F.lit(None).cast("string"))
        .otherwise((1 + F.col("n_chars") % 5).cast("string"))
        .alias("star_rating"),
        F.when(F.col("doc_id") % 89 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("text")).alias("review_body"))


def clean_docs(spark: SparkSession, sf_dir: str,
               spread_rows: bool = True) -> DataFrame:
    """B2: (doc_id, lang, body) with body in ``[a-z ]``."""
    d = table(spark, sf_dir, "documents", spread_rows)
    return d.select("doc_id", "lang", clean_text("text").alias("body"))


def doc_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, words ARRAY): every word of every text, in order."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", split_words(F.lower(
        F.regexp_replace("text", "[^a-zA-Z]", " "))).alias("words"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, pos BIGINT from 0, w), every word of every text."""
    d = table(spark, sf_dir, "documents")
    words = split_words(F.lower(F.regexp_replace("text", "[^a-zA-Z]", " ")))
    return (d.select("doc_id", "lang", F.posexplode(words).alias("pos", "w"))
            .withColumn("pos", F.col("pos").cast("long")))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HMM sequences (sent_id, pos from 1, word, tag) from ``events``.

    A sentence is what one user did in one week, so its length is bounded
    by time whatever the share of a user in all events is.
    """
    week = F.floor(F.datediff(F.to_date("ts"), F.lit("1970-01-01")) / 7)
    e = table(spark, sf_dir, "events").select(
        (F.col("user_id") * 10000 + week).cast("long").alias("sent_id"),
        "ts", "event_id", "event_type", "value")
    w = Window.partitionBy("sent_id").orderBy("ts", "event_id")
    ranked = e.withColumn("pos", F.row_number().over(w).cast("long"))
    return ranked.select(
        "sent_id", "pos",
        F.concat(F.lit("b"), F.floor(F.col("value") / 5).cast("int")
                 .cast("string")).alias("word"),
        F.col("event_type").alias("tag"))


def _is_cap(word) -> F.Column:
    return F.substring(word, 1, 1).rlike("^[A-Z]$")


def _text_labels(text: str) -> F.Column:
    """(word, cap, gold) of every word of a text, in order, as an array.

    Cut before each small word, a text falls into pieces of at most one small
    word and the run of capitalised words after it."""
    flat = F.btrim(F.regexp_replace(text, "[^a-zA-Z]+", " "))
    cut = F.split(F.regexp_replace(flat, " (?=[a-z])", "|"), "[|]")
    runs = F.transform(cut, lambda p: F.struct(F.split(p, " ").alias("w")))
    runs = F.transform(runs, lambda r: F.struct(
        r["w"].alias("w"), (F.array_min(F.transform(F.filter(r["w"], _is_cap),
                                                    F.length)) % 4).alias("m"),
        F.when(_is_cap(r["w"][0]), 0).otherwise(1).alias("first")))
    return F.filter(F.flatten(F.transform(runs, lambda r: F.transform(
        r["w"], lambda x, i: F.struct(
            x.alias("word"), F.when(_is_cap(x), 1).otherwise(0).alias("cap"),
            F.when(_is_cap(x), F.concat(
                F.when(i == r["first"], "B-").otherwise("I-"),
                F.when(r["m"] == 0, "PER").when(r["m"] == 1, "ORG")
                .when(r["m"] == 2, "LOC").otherwise("MISC")))
            .otherwise("O").alias("gold"))))),
        lambda x: F.length(x["word"]) > 0)


def entity_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sent_id, pos from 1, word, cap, gold, pred) BIO labels, whole texts.

    A run of capitalised words is one entity: ``B-`` then ``I-``; its type is
    (shortest word length in the run) % 4.  The prediction equals the gold
    label except ``O`` where the seeded hash's first hex digit is 0 or 1,
    which leaves ``I-`` after ``O`` and exercises span repair.

    A sentence is a whole text, so its labels are worked out where the row is
    and nothing is shuffled.  Only texts whose ``doc_id`` repeats or is null
    are one sentence together, by positions (:func:`label_runs`).
    """
    d = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("sent_id"), "text")
    own = d
    shared = d.groupBy("sent_id").agg(F.count(F.lit(1)).alias("n")).filter(
        (F.col("n") > 1) | F.col("sent_id").isNull()).select(
        F.col("sent_id").alias("_id"))
    some = not shared.isEmpty()
    if some:
        same = F.col("sent_id").eqNullSafe(F.col("_id"))
        own = d.join(shared, same, "left_anti")
    t = own.select("sent_id", F.posexplode(_text_labels("text")).alias(
        "pos", "x")).select("sent_id", (F.col("pos") + 1).cast("long")
                            .alias("pos"), "x.word", "x.cap", "x.gold")
    if some:
        t = t.unionByName(label_runs(d.join(shared, same, "left_semi")))
    drop = F.substring(seeded_md5("sent_id", "pos"), 1, 1).isin("0", "1")
    t = t.withColumn("pred", F.when(drop, "O").otherwise(F.col("gold")))
    return t.select("sent_id", "pos", "word", "cap", "gold", "pred")


def label_runs(d: DataFrame) -> DataFrame:
    """(sent_id, pos, word, cap, gold) of ``(sent_id, text)`` whose sentences
    may have several texts: neighbours and runs by position."""
    words = F.filter(F.split(F.regexp_replace("text", "[^a-zA-Z]", " "), " "),
                     lambda x: F.length(x) > 0)
    t = (d.select("sent_id", F.posexplode(words).alias("pos", "word"))
         .withColumn("pos", (F.col("pos") + 1).cast("long"))
         .withColumn("cap", F.when(F.substring("word", 1, 1)
                                   .rlike("^[A-Z]$"), 1).otherwise(0)))
    # capitalised runs without per-document windows: neighbours by blocks of
    # positions, run boundaries paired by a distributed per-document rank,
    # each run's tokens regenerated from its (start, end) and joined back
    n = neighbors(t, "sent_id", "pos", ["cap"], [-1, 1], keep=["word"])
    n = n.withColumn("pc", F.coalesce("cap_m1", F.lit(0))).withColumn(
        "nc", F.coalesce("cap_p1", F.lit(0)))
    ev = n.filter(F.col("cap") == 1).select("sent_id", "pos", F.explode(
        F.array(F.when(F.col("pc") == 0, F.lit(0)),
                F.when(F.col("nc") == 0, F.lit(1)))).alias("kind")).filter(
        F.col("kind").isNotNull())
    ev = block_rank(ev, "sent_id", "pos", ["pos", "kind"], "_r")
    runs = ev.groupBy("sent_id", F.floor((F.col("_r") + 1) / 2).alias("run")
                      ).agg(F.min("pos").alias("rs"), F.max("pos").alias("re"))
    members = runs.select("sent_id", "run", F.explode(
        F.sequence("rs", "re")).alias("pos"))
    lens = (members.join(n.select("sent_id", "pos", F.length("word")
                                  .alias("_l")), ["sent_id", "pos"])
            .groupBy("sent_id", "run").agg(F.min("_l").alias("run_min")))
    typed = members.join(lens, ["sent_id", "run"]).select(
        "sent_id", "pos", "run_min")
    t = n.join(typed, ["sent_id", "pos"], "left")
    run_min = F.col("run_min")
    etype = (F.when(run_min % 4 == 0, "PER").when(run_min % 4 == 1, "ORG")
             .when(run_min % 4 == 2, "LOC").otherwise("MISC"))
    gold = F.when(F.col("cap") == 0, "O").otherwise(
        F.concat(F.when(F.col("pc") == 1, "I-").otherwise("B-"), etype))
    return t.withColumn("gold", gold).select("sent_id", "pos", "word", "cap",
                                             "gold")


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, vec ARRAY<FLOAT>): the i-th most frequent token gets
    ``embeddings`` row ``vec_id = i - 1``."""
    tk = tokens(spark, sf_dir)
    counts = tk.groupBy("w").agg(F.count(F.lit(1)).alias("cnt"))
    ranked = global_row_number(counts, [F.desc("cnt"), F.col("w")], "r")
    emb = table(spark, sf_dir, "embeddings")
    return ranked.join(emb, emb.vec_id == ranked.r - 1).select(
        F.col("w").alias("word"), F.col("embedding").alias("vec"), "r")


def contraction_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with contractions injected for whole words."""
    d = table(spark, sf_dir, "documents")
    t = F.col("text")
    for word, short in (("the", "it's"), ("The", "It's"), ("and", "can't"),
                        ("is", "isn't"), ("to", "they've"), ("of", "I'll")):
        t = F.regexp_replace(t, f"\\b{word}\\b", short)
    return d.select("doc_id", t.alias("text"))
