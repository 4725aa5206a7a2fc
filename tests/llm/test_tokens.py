import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from textflow.llm import bpe
from textflow.llm.memo import ChunkMemo
from textflow.llm.queries import REGISTRY
from textflow.llm.token_counts import count_tokens, proven_words
from textflow.llm.token_files import (TokenFileReader, TokenFileWriter, fetch,
                                      open_store, read_token_files,
                                      write_token_files)
from textflow.llm.words import chunk_runs

SMALL = "/root/testdata/sf0.001"
WORD = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["a", "B", "é", "é", "'s", "'", "''re", " ", "  ", "\n", "\t",
         "12", "3", ".", "!", "—", "　", "ß", "İ", "Σ", "日本", "😀", "½",
         "<|endoftext|>", "<|", "\x1c", "\x85", "don't", "It's", "A.'s",
         "\x00", "_", "ing", "the", "====", "  \n "]


def _texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30)))
            for _ in range(n)]


@pytest.fixture(scope="module")
def word_ids():
    tok = Tokenizer.from_file(WORD)
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def byte_ids():
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                            mergeable_ranks=bpe.load_ranks(RANKS),
                            special_tokens={})
    return lambda t: enc.encode_ordinary(t or "")


def test_counts_equal_the_library(spark, edge_docs, word_ids):
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame(
        list(enumerate(_texts(1500, 1), 100)), "doc_id long, text string"))
    got = sorted((r.id or -1, r.n_bytes, r.n_tokens)
                 for r in count_tokens(docs, WORD).collect())
    assert got == sorted((r.doc_id or -1, len((r.text or "").encode()),
                          len(word_ids(r.text))) for r in docs.collect())


def test_proof_table_holds_only_single_tokens(word_ids):
    proven = set(proven_words(WORD).tolist())
    assert len(proven) > 10_000
    texts = ["the", "xqzvwk", "running", "dog's"]
    for r in chunk_runs(pa.array(texts), True, False):
        for i in range(r.rows):
            h = [int(x) for x in r.hash[r.ptr[i]:r.ptr[i + 1]]]
            if len(h) == 1 and h[0] in proven:
                assert len(word_ids(texts[r.first + i])) == 1


def test_counts_of_an_empty_table(no_docs):
    assert count_tokens(no_docs, WORD).count() == 0


def test_memo_starts_anew_beyond_its_limit():
    memo = ChunkMemo(lambda cs: [[len(c), c[0]] for c in cs], limit=3)
    for texts in (["ab cd"], ["e f g"], ["ab e hh i j"], [""]):
        for r in chunk_runs(pa.array(texts), True, False):
            ids, off = memo.ids(r)
            want = [x for w in texts[0].split() for x in (len(w), ord(w[0]))]
            assert ids.tolist() == want and off.tolist() == [0, len(want)]
            assert memo.counts(r).tolist() == [len(want)]


def test_bpe_equals_tiktoken(spark, edge_docs, byte_ids):
    docs = edge_docs.select("doc_id", "text").union(spark.createDataFrame(
        list(enumerate(_texts(1500, 2), 100)), "doc_id long, text string"))
    got = bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == docs.count()
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(r.text or "")
    for r in got:
        assert r.decoded in want[r.id]
        ids = byte_ids(r.decoded)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(
            " ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(
            r.decoded.encode()).hexdigest()


def test_transducer_on_raw_bytes_with_few_states():
    ranks = bpe.load_ranks(RANKS)
    fst, small = bpe.Transducer(ranks), bpe.Transducer(ranks, limit=40)
    rnd = random.Random(4)
    for _ in range(1500):
        raw = bytes(rnd.choice(b"abcdehilnorst \xc3\xa9\x80\xff")
                    for _ in range(rnd.randint(1, 40)))
        want = [ranks[x] for x in fst.merges.merge(raw)]
        assert fst.encode(raw) == want and small.encode(raw) == want
    # the whole-token rule of the format is never needed
    assert all(fst.merges.merge(b) == [b] for b in list(ranks)[::50])


def test_utf8_machine_is_the_codec_with_replacement():
    rnd = random.Random(5)
    ranks = bpe.load_ranks(RANKS)
    table = bpe.Merges(ranks).bytes_of
    machine = bpe.Utf8Machine(table)
    for _ in range(2000):
        ids = np.array([rnd.randrange(300 if rnd.random() < .7 else 50_000)
                        for _ in range(rnd.randint(0, 12))], np.int64)
        raw = b"".join(table[i] for i in ids)
        assert machine.decode(ids) == raw.decode("utf-8", "replace")


def test_bpe_of_an_empty_table(no_docs):
    out = bpe.encode_decode(no_docs, RANKS, public_tokenizers.PATTERN)
    assert out.count() == 0 and "ids" in out.columns


def test_token_files_round_trip(edge_docs, word_ids):
    manifest = write_token_files(edge_docs, WORD, 1)
    rows = read_token_files(manifest).collect()
    rows.sort(key=lambda r: r.start)
    want = sorted((r.doc_id if r.doc_id is not None else -1,
                   word_ids(r.text) + [1]) for r in edge_docs.collect())
    got = [(r.doc_id if r.doc_id is not None else -1, r.ids) for r in rows]
    assert sorted(got) == want
    assert [g[0] for g in got] == [w[0] for w in want]
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    some = fetch(manifest, [14, 19])
    assert {k: v.tolist() for k, v in some.items()} == {
        k: dict(want)[k] for k in (14, 19)}


def test_token_files_of_an_empty_table(no_docs):
    assert read_token_files(write_token_files(no_docs, WORD, 1)).count() == 0


def test_reader_decompresses_only_what_it_needs(tmp_path):
    path = str(tmp_path / "f.zst")
    w = TokenFileWriter(open(path, "wb"), 4)
    rnd = np.random.default_rng(1)
    docs = [rnd.integers(0, 1 << 31, n, dtype=np.uint32)
            for n in (10, 200_000, 0, 40_000, 5, 90_000)]
    for i, d in enumerate(docs):
        w.add(i * 3, d)
    w.close()
    r = TokenFileReader(path, 4)
    assert len(r.entries) > 4
    assert (r.tokens(4) == docs[4]).all() and r.frames_read == 1
    assert [i for i, _, _ in r.documents()] == [0, 3, 6, 9, 12, 15]
    assert all((a == b).all() for (_, _, a), b in zip(r.documents(), docs))
    assert all((r.tokens(i) == d).all() for i, d in enumerate(docs))


def test_damage_is_noticed(tmp_path):
    path = tmp_path / "f.zst"
    w = TokenFileWriter(open(path, "wb"), 2)
    w.add(1, np.arange(1000, dtype=np.uint32))
    w.close()
    raw = bytearray(path.read_bytes())
    r = TokenFileReader(str(path), 2)
    at = r.data_end // 2
    raw[at] ^= 0x55
    path.write_bytes(bytes(raw))
    with pytest.raises(Exception):
        TokenFileReader(str(path), 2).tokens(0)


def test_store_names():
    assert open_store("file:/tmp/x")[1] == "/tmp/x"
    assert open_store("file:///tmp/x")[1] == "/tmp/x"
    assert open_store("/tmp/x")[1] == "/tmp/x"


def test_registered_token_queries(spark, word_ids, byte_ids):
    docs = {r.doc_id: r.text for r in spark.read.parquet(
        f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    start = 0
    rows = {r.doc_id: r for r in REGISTRY["op3_token_files"](
        spark, SMALL).collect()}
    assert set(rows) == set(docs)
    for i in sorted(docs):
        ids = word_ids(docs[i]) + [1]
        assert (rows[i].start, rows[i].n_tokens) == (start, len(ids))
        assert rows[i].ids_crc32 == zlib.crc32(
            np.array(ids, "<u4").tobytes())
        start += len(ids)
    for r in REGISTRY["op4_token_counts"](spark, SMALL).collect():
        n = len(word_ids(docs[r.doc_id]))
        assert (r.n_tokens, r.over_limit) == (n, n > 2048)
    for r in REGISTRY["op5_byte_bpe"](spark, SMALL).collect():
        ids = byte_ids(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(
            " ".join(map(str, ids)).encode()).hexdigest()
