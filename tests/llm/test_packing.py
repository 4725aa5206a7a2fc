import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textflow.llm.packing import (TightestFit, encode_pieces, place, plan,
                                  sequences)
from textflow.llm.queries import REGISTRY

SMALL = "/root/testdata/sf0.001"
WORD = public_tokenizers.path("word_bpe_49k.json")


def one_by_one(lengths, capacity):
    """Best-fit decreasing as its definition says: (number of bins, sorted
    fills)."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= n]
        if fits:
            room[room.index(min(fits))] -= n
        else:
            room.append(capacity - n)
    return len(room), sorted(capacity - r for r in room)


@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 60))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    runs = plan(Counter(lengths), capacity)
    bins = defaultdict(list)
    starts = defaultdict(list)
    for r in runs:
        starts[r[0]].append(r[1:])
    for n, count in Counter(lengths).items():
        for number in range(count):
            first, seq, per, offset = max(
                s for s in starts[n] if s[0] <= number)
            j = number - first
            bins[seq + j // per].append((offset + j % per * n, n))
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):       # gapless
            assert offset == at
            at += n
        assert at <= capacity
    n_bins, fills = one_by_one(lengths, capacity)
    assert len(bins) == n_bins
    assert sorted(sum(n for _, n in b) for b in bins.values()) == fills


def test_plan_of_many_lengths_is_bounded():
    rnd = random.Random(3)
    counts = {n: rnd.randint(1, 10 ** 9) for n in range(1, 4097)}
    runs = plan(counts)
    assert len(runs) < 4 * 4096 * (math.log2(4096) + 3)
    assert sum(counts.values()) == sum(
        _pieces(runs, counts).values())
    with pytest.raises(ValueError):
        plan({5000: 1})


def _pieces(runs, counts):
    """Number of pieces the runs of each length cover, from 0 on."""
    by = defaultdict(list)
    for n, first, *_ in runs:
        by[n].append(first)
    for firsts in by.values():
        assert min(firsts) == 0 and len(set(firsts)) == len(firsts)
    return {n: counts[n] for n in by}


@given(st.sets(st.integers(0, 100)), st.integers(0, 100))
def test_tree_finds_the_tightest(rooms, need):
    tree = TightestFit(100)
    for r in range(101):
        tree.set(r, r % 3 == 0)
    for r in range(101):
        tree.set(r, r in rooms)
    assert tree.at_least(need) == min((r for r in rooms if r >= need),
                                      default=None)


def _check(rows, docs, capacity):
    """Rows against the library, gapless sequences, and the one-by-one
    packing."""
    tok = Tokenizer.from_file(WORD)
    expect = Counter()
    lengths = []
    for doc_id, text in docs:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids
                       + [1], "<u4")
        for k, lo in enumerate(range(0, len(ids), capacity)):
            cut = ids[lo:lo + capacity]
            lengths.append(len(cut))
            expect[doc_id, k, lo, len(cut), zlib.crc32(cut.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"],
                    r["ids_crc32"]) for r in rows) == expect
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= capacity
    n_bins, fills = one_by_one(lengths, capacity)
    assert len(bins) == n_bins
    assert sorted(sum(n for _, n in b) for b in bins.values()) == fills


def test_query_equals_one_by_one_packing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [r.asDict() for r in
            REGISTRY["op12_best_fit_packing"](spark, SMALL).collect()]
    _check(rows, [(r.doc_id, r.text) for r in docs.collect()], 4096)


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_edge_rows_and_small_sequences(spark, edge_docs, capacity):
    from pyspark.sql import functions as F
    docs = edge_docs.filter("length(coalesce(text, '')) < 20000")
    pieces = encode_pieces(docs, WORD, capacity)
    rows = [r.asDict() | {"doc_id": r.id} for r in place(
        pieces.withColumn("ids_crc32", F.crc32("ids")), capacity).collect()]
    _check(rows, [(r.doc_id, r.text) for r in docs.collect()], capacity)


def test_long_text_is_cut_and_sequences_hold_the_ids(spark, edge_docs):
    tok = Tokenizer.from_file(WORD)
    pieces = encode_pieces(edge_docs, WORD)
    placed = place(pieces).collect()
    assert max(r.piece for r in placed) > 10        # 60,000 words
    whole = {r.sequence_id: (r.n_tokens, np.frombuffer(r.ids, "<u4"))
             for r in sequences(pieces).collect()}
    texts = Counter()
    for r in placed:
        n, ids = whole[r.sequence_id]
        assert len(ids) == n <= 4096
        assert ids[r.offset:r.offset + r.length].tobytes() == r.ids
        texts[r.id] += r.length
    expect = Counter()
    for r in edge_docs.collect():
        expect[r.doc_id] += 1 + len(tok.encode(
            r.text or "", add_special_tokens=False).ids)
    assert texts == expect


def test_no_documents(spark, no_docs):
    assert place(encode_pieces(no_docs, WORD)).count() == 0
    assert sequences(encode_pieces(no_docs, WORD)).count() == 0
