"""Corrections by blocks against all pairs, and what they send around."""

import random

import numpy as np
import pyarrow as pa
import pytest

from textflow.operators import edits, spell


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def some_words(seed, n=120):
    rnd = random.Random(seed)
    words = {"", "a", "é", "\U0001f600b", "x" * 40, "x" * 39 + "yz"}
    while len(words) < n:
        w = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 15)))
        words.add(w)
        i = rnd.randrange(len(w) + 1)
        words.add(w[:i] + rnd.choice(["", "d"]) + w[i + 1:])
    return sorted(words, key=lambda w: rnd.random())


@pytest.mark.parametrize("most", [1, 2])
def test_distances(most):
    words = some_words(3)
    w = edits.Words(pa.array(words))
    i, j = map(np.ravel, np.meshgrid(range(len(words)), range(len(words))))
    got = edits.distances(w, i, w, j, most)
    assert got.tolist() == [min(levenshtein(words[a], words[b]), most + 1)
                            for a, b in zip(i, j, strict=True)]


@pytest.mark.parametrize("group", [[], ["lang"]])
def test_corrections_equal_all_pairs(spark, monkeypatch, group):
    monkeypatch.setattr(spell, "DICTIONARY_BLOCK", 30)
    monkeypatch.setattr(spell, "WORD_BLOCK", 25)
    monkeypatch.setattr(edits, "PAIRS", 5)
    rnd = random.Random(8)
    rows = [(rnd.choice(["x", "y", None]), w, rnd.choice([1, 2, 30, 40]))
            for w in some_words(4)]
    known = spark.createDataFrame(rows, "lang string, word string, cnt long")
    got = {(r.lang if group else "", r.word): (r.correction, r.distance)
           for r in spell.spell_corrections(known, "word", group, known=(
               known.filter("cnt >= 20"), known.filter("cnt < 20"))).collect()}
    want = {}
    for lang, word, n in rows:
        if n < 20 and (lang or not group):
            near = [(levenshtein(word, d), -m, d) for other, d, m in rows
                    if m >= 20 and (other == lang or not group)]
            best = min(near)
            if best[0] <= 2:
                want[lang if group else "", word] = (best[2], best[0])
    assert got == want and got


def test_keys_stay_in_their_task(spark):
    """Broadcast or shuffled, the keys were some sixty rows a word."""
    t = spark.createDataFrame([("x", w) for w in some_words(5)],
                              "lang string, w string")
    plan = spell.spell_corrections(t, "w", ["lang"], 1)._jdf.queryExecution(
        ).optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "xxhash64(substring" not in plan
    assert "levenshtein" not in plan
