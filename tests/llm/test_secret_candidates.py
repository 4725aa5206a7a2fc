"""Credentials of any form of the labelled ones, wherever they stand."""

import random
import time
from collections import Counter

from pyspark.sql import functions as F

from textflow.llm import secrets
from textflow.llm.secrets import scan_secrets

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)),
                               "doc_id long, text string")
    return {r.id: [(s.kind, s.value) for s in r.found if s.kind == "inferred"]
            for r in scan_secrets(df).collect()}


def _word(rnd, n, chars):
    return "".join(rnd.choice(chars) for _ in range(n))


def test_short_letter_only_and_dotted_credentials(spark):
    rnd = random.Random(3)
    short = [_word(rnd, 8, UPPER) for _ in range(200)]
    dotted = [f"{_word(rnd, 4, UPPER)}.{_word(rnd, 4, UPPER)}"
              for _ in range(200)]
    texts = [f"the password: {v} is in the usual place\n"
             + "some more of the words here " * 20 for v in short + dotted]
    texts += ["see QWXZKJVB now", "see WQKX.ZJVB, now", "plain longwords only",
              "at http://host/QWXZKJVB/x?key=ZZTOPQRS", "a=QWXZKJVB."]
    got = _scan(spark, texts)
    n = len(short + dotted)
    assert [v for _, v in got[n]] == ["QWXZKJVB"]
    assert [v for _, v in got[n + 1]] == ["WQKX.ZJVB"]
    assert got[n + 2] == []
    assert [v for _, v in got[n + 3]] == ["QWXZKJVB", "ZZTOPQRS"]
    assert [v for _, v in got[n + 4]] == ["QWXZKJVB"]


def test_lengths_come_from_all_values(spark, monkeypatch):
    rnd = random.Random(4)
    values = [_word(rnd, n, UPPER) for n in range(6, 30) for _ in range(8)]
    df = spark.createDataFrame(
        [(f"secret = {v}",) for v in values], "text string")
    labels = df.mapInArrow(secrets._label(secrets.pa.schema(
        [("kind", "string"), ("value", "string"), ("n", "int64")])),
        secrets._LABELLED)
    g = secrets.infer_grammars(labels, sample=20)
    least, lo, hi = g.limits["assign"]
    assert (lo, hi) == (6, 29)
    scores = sorted(x for x in (g.score("assign", v) for v in set(values))
                    if x > float("-inf"))
    assert 0 <= scores[len(scores) // 100] - least <= secrets.SCORE_STEP
    chars = labels.filter("kind = 'background'").groupBy().agg(
        F.sum("n")).first()[0]
    assert chars == sum(map(len, values)) + len("secret=") * len(values)


def test_overlaps():
    base = [("hex", 10, 20, "")]
    found = [(0, 8, "a"), (0, 3, "b"), (6, 9, "c"), (9, 11, "d"),
             (20, 26, "e"), (27, 33, "f")]
    assert [v for *_, v in secrets._outside(found, base)] == ["a", "e", "f"]


def _grammars(words, lo, hi):
    g = secrets.Grammars({"assign": words}, Counter("".join(words)))
    g.limit("assign", min(x for x in (g.score("assign", w) for w in words)
                          if x > float("-inf")), lo, hi)
    return g


def test_walks_find_what_scoring_every_piece_finds():
    rnd = random.Random(6)
    g = _grammars([_word(rnd, rnd.randint(6, 14), "abC0/.") for _ in range(
        80)], 6, 14)
    least, lo, hi = g.limits["assign"]
    for _ in range(40):
        run = _word(rnd, rnd.randint(0, 120), "abC0/.=z")
        cuts = [i for i, c in enumerate(run) if c in secrets.PIECE_ENDS]
        want = sorted({
            (s, e) for s in [0, *(i + 1 for i in cuts)]
            for e in [*cuts, len(run)]
            if lo <= e - s <= hi and g.score("assign", run[s:e]) >= least})
        assert g.secrets(run) == want
        taken = [(3, 9), (40, 41)]
        whole = [(s, e, run[s:e]) for s, e in want]
        assert g.longest_secrets(run, taken) == [
            f[:2] for f in secrets._outside(whole, [
                ("hex", s, e, "") for s, e in taken])]


def test_long_runs_beside_a_long_label():
    rnd = random.Random(7)
    words = [_word(rnd, 20, "abcdef0123456789") for _ in range(200)]
    words += ["xy/" * 666 + "xy"]
    g = _grammars(words, 20, 2000)
    begin = time.time()
    assert g.longest_secrets("xy/" * 33_333, [])
    assert time.time() - begin < 20
    found = [(3 * i, 3 * i + 30, "v") for i in range(30_000)]
    assert len(secrets._outside(found, [("assign", 0, 5, "v")])) == 3_000
    assert time.time() - begin < 25


def test_outside_looks_at_base_spans_that_touch():
    base = [("assign", 40, 60, "v")]
    found = [(0, 10, "a"), (0, 45, "b"), (5, 12, "c"), (59, 70, "d"),
             (60, 70, "e")]
    assert secrets._outside(found, base) == [(0, 10, "a"), (60, 70, "e")]
