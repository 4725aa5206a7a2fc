"""Spelling applied to whole texts: every word, whatever stands around it."""

import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textflow.functions import text as T
from textflow.functions.constants import CONTRACTIONS
from textflow.operators import spell
from textflow.queries import spelled
from textflow.sources import fixtures as fx

SMALL = "/root/testdata/sf0.001"
CORPUS = ["the house is on the hill a lot"] * 30 + ["houes alot"]
WORD = re.compile(r"(?i)\b(?:" + "|".join(c for c, _ in CONTRACTIONS)
                  + r")\b|[a-z]+", re.ASCII)


def _tokens(spark, texts):
    df = spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)],
                               "doc_id long, lang string, text string")
    words = T.split_words(F.lower(F.regexp_replace("text", "[^a-zA-Z]", " ")))
    return df, df.select("doc_id", "lang",
                         F.posexplode(words).alias("pos", "w")).withColumn(
        "pos", F.col("pos").cast("long"))


@pytest.mark.parametrize("raw, want", [
    ("houes", "house"), ("Houes, HOUES!\nhoues\t(houes) houes2",
                         "House, HOUSE!\nhouse\t(house) house2"),
    ("the hou se. Hou\nse", "the house. House"),
    ("Alot on", "A lot on"), ("don't Alot", "don't A lot"),
    ("", ""), ("12, !", "12, !"), ("xyzzyqq  the", "xyzzyqq  the"),
])
def test_words_in_any_place_are_corrected(spark, raw, want):
    df, _ = _tokens(spark, [*CORPUS, raw])
    _, tokens = _tokens(spark, [*CORPUS, raw])
    got = spell.correct_texts(df, tokens, group=["lang"])
    assert got.filter(f"doc_id = {len(CORPUS)}").first()["text"] == want


def _by_hand(text, words, lang, dic):
    runs = list(WORD.finditer(text))
    out, end, i = [], 0, 0
    while i < len(runs):
        m, n = runs[i], 1
        w = m[0].lower()
        new = words.get((lang, w))
        if i + 1 < len(runs):
            nw = runs[i + 1][0].lower()
            if (lang, w + nw) in dic and not (
                    (lang, w) in dic and (lang, nw) in dic):
                new, n = w + nw, 2
        raw = "".join(r[0] for r in runs[i:i + n])
        if new is None:
            new = m[0]
        elif len(raw) > 1 and raw.isupper():
            new = new.upper()
        elif raw[0].isupper():
            new = new[0].upper() + new[1:]
        out += [text[end:m.start()], new]
        end = runs[i + n - 1].end()
        i += n
    return "".join(out) + text[end:]


def test_whole_table_equals_plain_python(spark):
    docs = fx.table(spark, SMALL, "documents")
    tokens = fx.tokens(spark, SMALL)
    words = {(r.lang, r.word): r.new for r in spell.word_changes(
        tokens, group=["lang"]).collect()}
    counts = Counter((r.lang, r.w) for r in tokens.collect())
    dic = {k for k, n in counts.items() if n >= 20}
    got = {r.doc_id: r.text for r in spelled(
        spark, SMALL, F.col("text")).collect()}
    rows = docs.select("doc_id", "lang", "text").collect()
    assert len(got) == sum(r.text is not None for r in rows)
    for r in rows:
        if r.text is not None:
            assert got[r.doc_id] == _by_hand(r.text, words, r.lang, dic)


def test_many_changes_in_one_text_stay_linear(spark):
    """80,000 corrections, merges and cuts in one text."""
    n = 20_000
    df, tokens = _tokens(spark, CORPUS)
    raw = "Houes alot hou se hou se on "
    df = df.union(spark.createDataFrame([(-1, "en", raw * n)], df.schema))
    got = spell.correct_texts(df, tokens, group=["lang"]).filter("doc_id < 0")
    begin = time.time()
    assert got.first()["text"] == "House a lot house house on " * n
    assert time.time() - begin < 30


def test_chain_of_merges_goes_from_left_to_right(spark):
    corpus = ["anan an xan"] * 30
    _, tokens = _tokens(spark, corpus)
    tokens = tokens.filter("w <> 'an'")     # only the joined form is known
    df, _ = _tokens(spark, ["an an an", "an, an an\nan an"])
    got = {r.doc_id: r.text for r in spell.correct_texts(
        df, tokens, group=["lang"]).collect()}
    assert got == {0: "anan an", 1: "anan anan an"}
