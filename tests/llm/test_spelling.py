import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given
from hypothesis import strategies as st

from textflow.llm import spelling
from textflow.llm.queries import REGISTRY
from textflow.llm.spelling import near_words, roots, spelling_groups

SMALL = "/root/testdata/sf0.001"
RUN = regex.compile("[A-Za-zÀ-ÿ]+")


def lower(w):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)


def plain_vocabulary(docs):
    c = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % 31 == 0:
                p = h % len(w)
                w = w[:p] + w[p + 1:]
            c[w] += 1
    return {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}


def one_edit_away(w):
    """Words with a letter less; two words are one replacement apart if they
    lose the same place."""
    return [w[:i] + w[i + 1:] for i in range(len(w))]


def plain_near(vocab):
    near = {w: set() for w in vocab}
    holes = {}
    for w in vocab:
        for v in one_edit_away(w):
            if v in near:
                near[w].add(v)
                near[v].add(w)
        for i in range(len(w)):
            holes.setdefault((i, w[:i] + "\0" + w[i + 1:]), []).append(w)
    for group in holes.values():
        for w in group:
            near[w] |= set(group) - {w}
    return near


def plain_groups(docs):
    vocab = plain_vocabulary(docs)
    near = plain_near(vocab)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best and vocab[best] >= 10 * vocab[w] else None
    out = {}
    for w in vocab:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, vocab[w], len(near[w]),
                  vocab[form[w]] if form[w] else None)
    return out


def groups_of(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_plain_version(spark):
    docs = [(r.doc_id, r.text) for r in
            spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = groups_of(REGISTRY["op13_spelling_variants"](spark, SMALL))
    expect = plain_groups(docs)
    assert got == expect
    assert sum(v[3] > 0 for v in expect.values()) > 100


def variants(seed, n):
    """Texts of made-up words and their misspellings, with other letters."""
    rnd = random.Random(seed)
    letters = "abcdeilnorstéßÿÀ×"
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(6, 11)))
            for _ in range(40)]
    words = list(base)
    for w in base * 6:
        i = rnd.randrange(len(w))
        words.append(rnd.choice([
            w[:i] + w[i + 1:], w[:i] + rnd.choice(letters) + w[i:],
            w[:i] + rnd.choice(letters) + w[i + 1:],
            w[:i] + w[i + 1:i + 2] + w[i:i + 1] + w[i + 2:]]))
    weight = [1 + 300 // (k + 1) for k in range(len(words))]
    return [(k, " ".join(rnd.choices(words, weight, k=200)).title()
             if k % 3 else ", ".join(rnd.choices(words, weight, k=200)))
            for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_made_up_misspellings(spark, seed):
    docs = variants(seed, 60)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    expect = plain_groups(docs)
    assert groups_of(spelling_groups(df)) == expect
    assert any(f for f, *_ in expect.values())


def test_edge_rows(spark, edge_docs):
    expect = plain_groups([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert groups_of(spelling_groups(edge_docs)) == expect


def test_no_documents(spark, no_docs):
    assert spelling_groups(no_docs).count() == 0


def test_tiles_lose_no_pair(spark):
    """Files far larger than a tile: all words share three quarters of their
    letters."""
    rnd = random.Random(9)
    words = sorted({"".join(rnd.choice("ab") for _ in range(
        rnd.randint(7, 9))) for _ in range(900)})
    df = spark.createDataFrame([(w, 2) for w in words],
                               "word string, n long").repartition(3)
    got = sorted((r.word, r.other) for r in near_words(df, tile=8).collect())
    expect = sorted((w, v) for w, o in plain_near(
        dict.fromkeys(words, 2)).items() for v in o)
    assert got == expect


def test_very_long_words(spark):
    long = "abcdefghij" * 500
    docs = [(1, " ".join([long, long, long[1:], long[1:], long[:99] + "z"
                          + long[100:]] * 2))] * 2
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert groups_of(spelling_groups(df)) == plain_groups(docs)


def test_chains_of_forms(spark):
    rows = [(f"w{k}", f"w{k + 1}") for k in range(18)] + [("x", "y")]
    got = {r.word: r.root for r in roots(spark.createDataFrame(
        rows, "word string, form string")).collect()}
    assert got == {f"w{k}": "w18" for k in range(18)} | {"x": "y"}


WORD = st.text("abcé", min_size=1, max_size=7)


@given(st.lists(st.tuples(WORD, WORD), min_size=1, max_size=30))
def test_one_edit(pairs):
    pairs = [tuple(sorted(p, key=len)) for p in pairs]
    pairs = [p for p in pairs if len(p[1]) - len(p[0]) <= 1]
    if not pairs:
        return
    a, b = (spelling.Letters(pa.array(x)) for x in zip(*pairs, strict=True))
    rows = np.arange(len(pairs))
    ca, cb = a.codes(rows), b.codes(rows)
    w = max(ca.shape[1], cb.shape[1])
    ca, cb = (np.pad(c, ((0, 0), (0, w - c.shape[1]))) for c in (ca, cb))
    assert spelling.one_edit(ca, cb).tolist() == [
        (len(x) < len(y) and x in one_edit_away(y))
        or (len(x) == len(y) and sum(p != q for p, q in zip(
            x, y, strict=True)) == 1) for x, y in pairs]


@given(st.lists(st.tuples(st.integers(0, 10 ** 6), st.text(
    "abcXYZÀÿ×Ā -1 ", max_size=40)), max_size=6))
def test_words_of_a_piece(docs):
    got = Counter()
    for r in spelling.letter_runs(pa.array([t for _, t in docs],
                                           pa.string())):
        words, n = spelling._runs_to_words(
            [f"{i}:" for i, _ in docs][r.first:r.first + r.rows], r)
        for w, k in zip(words, n.tolist(), strict=True):
            got[w.decode()] += k
    expect = Counter()
    for i, text in docs:
        for run in RUN.findall(text):
            w = lower(run)
            h = zlib.crc32(f"{i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                expect[w] += 1
    assert got == expect
