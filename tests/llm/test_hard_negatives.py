import math
import random
from collections import Counter

import numpy as np
import pytest

from textflow.llm import hard_negatives as hn
from textflow.llm.queries import REGISTRY

SMALL = "/root/testdata/sf0.001"


def plain(rows, every=100):
    """All scores of all anchors, as the definition says."""
    live = []
    for ident, vec, label in rows:
        if ident is None or label is None or vec is None or any(
                x is None or not math.isfinite(x) for x in vec):
            continue
        live.append((ident, [math.floor(256 * x) for x in vec], label))
    width = max((len(v) for _, v, _ in live), default=1)
    m = np.array([v + [0] * (width - len(v)) for _, v, _ in live],
                 np.int64).reshape(-1, width)
    out = Counter()
    for a, (ident, _, label) in enumerate(live):
        if ident % every:
            continue
        s = (m @ m[a]).tolist()
        order = sorted(range(len(live)), key=lambda i: (-s[i], live[i][0]))
        pos = [i for i in order if i != a and live[i][2] == label][:5]
        for p in pos:
            neg = [i for i in order if live[i][2] != label
                   and 30 * s[p] <= 100 * s[i] <= 90 * s[p]][:10]
            for r, i in enumerate(neg, 1):
                out[ident, live[p][0], r, live[i][0], s[p], s[i]] += 1
    return out


def got(df):
    cols = ["anchor_id", "positive_id", "rank", "negative_id",
            "positive_score", "negative_score"]
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "vec_id long, embedding array<float>, label int").repartition(3)


def test_query_equals_all_scores(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.label is not None
             and r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(
                 f"{SMALL}/embeddings.parquet").collect()]
    expect = plain(rows)
    assert got(REGISTRY["op11_hard_negatives"](spark, SMALL)) == expect
    assert expect


def made_up(seed, n=700, dims=6):
    """Few directions, many equal vectors and ties, zero vectors, gaps."""
    rnd = random.Random(seed)
    heads = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(9)]
    rows = []
    for i in range(n):
        h = rnd.choice(heads)
        spread = rnd.choice([0, 0, 0.02, 0.3])
        v = [x + rnd.gauss(0, spread) if spread else x for x in h]
        rows.append((i, v, rnd.randrange(3)))
    rows += [(3, None, 1), (n, [0.0] * dims, 1), (n + 1, [0.0] * dims, 2),
             (n + 2, [float("nan")] * dims, 1), (n + 3, heads[0], None),
             (n + 4, [float("inf")] + heads[0][1:], 1),
             (n + 5, [None] + heads[0][1:], 1), (None, heads[0], 1),
             (n + 6, heads[0][:3], 2), (0, heads[0], 0), (0, heads[0], 0),
             (20, heads[1], 2), (n + 7, [], 0)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_ties_repeats_and_broken_rows(spark, seed, monkeypatch):
    # many blocks, lists and segments
    monkeypatch.setattr(hn, "BLOCK_CELLS", 6 * 16)
    monkeypatch.setattr(hn, "FIRST_SEGMENT", 8)
    rows = made_up(seed)
    rows = [(i, None if v is None else [
        None if x is None else float(np.float32(x)) for x in v], y)
        for i, v, y in rows]
    assert got(hn.hard_negatives(frame(spark, rows), anchor_every=20)
               ) == plain(rows, 20)


def test_walk_stops_early():
    """Certified termination computes a part of all scores, and nothing is
    lost by it."""
    rnd = np.random.default_rng(4)
    heads = rnd.normal(size=(20, 16))
    own = rnd.integers(0, 20, 6000)
    vec = np.floor(256 * (heads[own] + 0.05 * rnd.normal(size=(6000, 16)))
                   ).astype(np.int64)
    label = rnd.integers(0, 4, 6000)
    ident = np.arange(6000)
    a = np.arange(0, 6000, 20)
    centre = hn.centres(vec[a])
    d, _ = hn.unit(vec[a])
    block = hn.Block(a, label[a], vec[a], (d @ centre.T).argmax(1), centre)
    block.low = np.full((1, len(a)), hn.NONE)
    block.high = np.full((1, len(a)), np.iinfo(np.int64).max)
    tops = hn.Tops(1, len(a), 5, block.low)
    work = hn.walk(block, tops, ident, ident, label, vec, True)
    assert work < len(a) * 6000 / 3
    for i, row in enumerate(a):
        s = vec @ vec[row]
        mine = [j for j in np.lexsort((ident, -s))
                if label[j] == label[row] and j != row][:5]
        assert tops.rows[0, i][1].tolist() == mine


def test_large_components_are_exact(spark):
    rows = [(i, [float(2 ** 20 + i), float(2 ** 20 - 3 * i)], i % 2)
            for i in range(60)]
    assert got(hn.hard_negatives(frame(spark, rows), anchor_every=20)
               ) == plain(rows, 20)


def test_few_rows_and_none(spark):
    assert got(hn.hard_negatives(frame(spark, []))) == Counter()
    assert got(hn.hard_negatives(frame(spark, [(0, [1.0], 1)]))) == Counter()
    rows = [(0, [1.0], 1), (1, [0.5], 1), (2, [0.3], 2), (3, [0.1], 3)]
    assert got(hn.hard_negatives(frame(spark, rows))) == plain(rows)


def test_clashing_columns(spark):
    rows = [(i, [float(i % 7), 1.0], i % 2) for i in range(120)]
    df = frame(spark, rows).selectExpr(
        "*", "1 as uid", "2 as id", "3 as q", "4 as `block.x`", "5 as rank")
    assert got(hn.hard_negatives(df)) == plain(rows)
