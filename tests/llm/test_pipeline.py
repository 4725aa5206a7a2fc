import hashlib

import corpus_pipeline
import public_tokenizers
import tiktoken

from textflow.llm.bpe import load_ranks

from .conftest import ascii_lower, near_classes, words_of
from .test_decontaminate import _expected

SMALL = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    want = {i for i, r in rows.items() if any(map(str.isalpha, r.text or ""))}
    exact = {}
    for i in want:
        t = ascii_lower(rows[i].text)
        exact[t] = max(i, exact.get(t, -1))
    want = set(exact.values())
    near = near_classes([(i, rows[i].text) for i in want])
    want = {max(g) for g in near.values()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(
        f"{SMALL}/benchmark.parquet").collect()]
    # only documents that share a window's words need the slow comparison
    starts = {tuple(words_of(t)[j:j + 3]) for _, t in items
              for j in range(len(words_of(t)) - 2)}

    def clean(text):
        w = words_of(text)
        if not any(tuple(w[p:p + 3]) in starts for p in range(len(w))):
            return True
        return not _expected(text, items)[-1]

    want = {i for i in want if clean(rows[i].text)}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in got} == want and len(got) == len(want)
    enc = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=load_ranks(
            public_tokenizers.path("byte_bpe_50k.tiktoken")))
    for r in got:
        text = rows[r.doc_id].text
        assert r.ids == enc.encode_ordinary(text)
        assert r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_keep_columns_and_take_edge_rows(spark, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, edge_docs, SMALL)
        assert out.columns == edge_docs.columns, name
        assert 0 < out.count() <= edge_docs.count()
        assert stage(spark, no_docs, SMALL).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, edge_docs, SMALL).count() == edge_docs.count()
    assert last(spark, no_docs, SMALL).count() == 0
