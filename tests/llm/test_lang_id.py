import itertools
import zlib

import numpy as np
import pyarrow as pa

from textflow.llm.lang_id import (fit, forward_backward, label_piece, predict,
                                  train)
from textflow.llm.queries import REGISTRY
from textflow.llm.words import LETTERS, word_runs

SF = "/root/testdata/sf0.01"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    size = np.array([3, 1, 4, 2])
    start = np.cumsum(size) - size
    emit, trans = rng.random((10, 3)) + .1, rng.random((3, 3)) + .1
    alpha, beta = forward_backward(emit, trans, start, size)
    prob = alpha * beta
    prob /= prob.sum(1, keepdims=True)
    for s, n in zip(start, size):
        want = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            p = np.prod([emit[s + t, y] for t, y in enumerate(path)])
            p *= np.prod([trans[a, b] for a, b in zip(path, path[1:])])
            for t, y in enumerate(path):
                want[t, y] += p
        want /= want.sum(1, keepdims=True)
        assert np.allclose(prob[s:s + n], want)


def test_code_switched_text_is_labelled_word_by_word():
    de = "der hund und die katze sind nicht mit dem ball auf das haus gegangen"
    en = "the dog and the cat have not been with this ball on that house today"
    texts = [de + ". " + de, en + "! " + en] * 20
    model = fit(pa.array(texts), ["de", "en"] * 20)
    mixed = "the dog and the cat sind nicht auf dem haus gegangen"
    r = next(word_runs(pa.array([mixed]), LETTERS))
    best = [model.langs[i] for i in label_piece(model, r).argmax(1)]
    assert best == ["en"] * 5 + ["de"] * 6


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(
        f"{SF}/documents.parquet").collect()}
    got = REGISTRY["op10_lang_id"](spark, SF).collect()
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
               and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    right = sum(r.lang_pred == lang[r.doc_id] for r in held)
    assert right / len(held) > 0.98


def test_edge_rows(spark, edge_docs, no_docs):
    model = train(edge_docs)
    got = predict(edge_docs, model).collect()
    assert len(got) == edge_docs.count()
    for r in got:
        text = r.row.text or ""
        letter = any(c.isalpha() for c in text)
        assert (r.lang_pred == "und") == (not letter)
        assert (r.score > 0) == letter
        if letter and text.isascii():
            assert sum(s.n_words for s in r.segments) >= 1
    assert predict(no_docs, model).count() == 0
    nothing = train(no_docs)
    assert {r.lang_pred for r in predict(edge_docs, nothing).collect()
            } == {"und"}
    # labels, sources and ids are no inputs of a prediction
    again = predict(edge_docs.selectExpr("text", "'xx' as lang"), model)
    assert sorted((r.row.text or "", r.lang_pred) for r in again.collect()
                  ) == sorted((r.row.text or "", r.lang_pred) for r in got)
