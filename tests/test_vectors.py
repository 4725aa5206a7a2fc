"""Document vectors against plain Python."""

import numpy as np
import pytest

from textflow.operators import vectors

RNG = np.random.default_rng(5)
WORDS = [f"w{i}" for i in range(40)]
VECTORS = [(w, RNG.normal(size=4).astype(np.float32).tolist())
           for w in WORDS[::2]]
#: documents of other lengths; known words are rare in some, one id is null
DOCS = {i: RNG.choice(WORDS if i % 3 else [*WORDS[1::2], *["w2"] * (i % 2)],
                      size=n).tolist()
        for i, n in enumerate([0, 1, 5, 90, 12, 200, 300, 3, 25])} | {
            None: ["w0", "w1", "w4"] * 9,
            77: ["w0", "w1"] * 3 + ["w3"] * 60 + ["w6", "w8", "w8"] * 4}


def _frames(spark):
    tokens = spark.createDataFrame(
        [(d, p, w) for d, ws in DOCS.items() for p, w in enumerate(ws)],
        "doc_id long, pos long, w string").repartition(7)
    return tokens, spark.createDataFrame(VECTORS,
                                         "word string, vec array<float>")


def _known(ws):
    table = dict(VECTORS)
    return [table[w] for w in ws if w in table]


@pytest.mark.parametrize("pairs", [5, 1 << 20])
def test_means(spark, monkeypatch, pairs):
    monkeypatch.setattr(vectors, "SHARD_PAIRS", pairs)
    got = {r.doc_id: r.mean for r in vectors.doc_mean_vectors(
        *_frames(spark)).collect()}
    want = {d: np.mean(_known(ws), axis=0) for d, ws in DOCS.items()
            if _known(ws)}
    assert set(got) == set(want)
    for d, mean in want.items():
        assert np.allclose(got[d], mean, atol=1e-6), d


def test_first_known_words(spark):
    tokens, vecs = _frames(spark)
    got = {r.doc_id: r.concat for r in vectors.doc_concat_vectors(
        tokens, vecs, 10).collect()}
    want = {d: _known(ws)[:10] for d, ws in DOCS.items() if _known(ws)}
    assert any(len(_known(ws[:40])) < 10 <= len(_known(ws))
               for ws in DOCS.values())       # the second look-up is needed
    assert set(got) == set(want)
    for d, vs in want.items():
        flat = [x for v in vs for x in v]
        assert got[d] == flat + [0.0] * (40 - len(flat)), d


def test_no_vector_for_every_pair(spark):
    tokens, vecs = _frames(spark)
    plan = vectors.doc_mean_vectors(tokens, vecs)._jdf.queryExecution(
        ).optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Summarizer" not in plan


@pytest.mark.parametrize("pairs", [5, 1 << 23])
def test_means_of_whole_texts(spark, monkeypatch, pairs):
    """The words of a text travel as one row, not a row for each."""
    monkeypatch.setattr(vectors, "SHARD_PAIRS", pairs)
    monkeypatch.setattr(vectors, "WORDS_AT_ONCE", 7)
    tokens, vecs = _frames(spark)
    twice = vecs.union(vecs.filter("word = 'w2'"))
    lists = spark.createDataFrame(
        [(d, ws[x:x + 50]) for d, ws in DOCS.items()
         for x in range(0, max(len(ws), 1), 50)] + [(1234, None)],
        "doc_id long, words array<string>").repartition(5)
    table = [(w, v) for w, v in VECTORS] + [
        (w, v) for w, v in VECTORS if w == "w2"]
    for frame, known in ((vecs, VECTORS), (twice, table)):
        means = vectors.doc_mean_vectors(tokens, frame, lists=lists)
        got = {r.doc_id: r.mean for r in means.collect()}
        want = {d: np.mean([v for w in ws for x, v in known if x == w], axis=0)
                for d, ws in DOCS.items() if any(w in dict(known) for w in ws)}
        assert set(got) == set(want)
        for d, mean in want.items():
            assert np.allclose(got[d], mean, atol=1e-6), d
    plan = means._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "explode" not in plan
