import random

import numpy as np
import pyarrow as pa

from textflow.llm import near_dedup
from textflow.llm.near_dedup import (LEVELS, bands_of, components,
                                     drop_near_copies, near_groups, overlap,
                                     rest_of, signatures)

from .conftest import near_classes


def test_signature_agreement_is_weighted_jaccard():
    rnd = random.Random(1)
    elems = np.array([rnd.getrandbits(64) for _ in range(120)], np.uint64)
    for lo, hi in ((1, 1), (1, 6), (1, 14)):
        ca = [rnd.randint(lo, hi) for _ in elems]
        cb = [rnd.randint(lo, hi) if i % 2 else c for i, c in enumerate(ca)]
        ca[:15], cb[-15:] = [0] * 15, [0] * 15
        a, b = np.repeat(elems, ca), np.repeat(elems, cb)
        sig = signatures(np.concatenate([a, b]),
                         np.array([0, len(a), len(a) + len(b)]), 4000)
        want = sum(map(min, ca, cb)) / sum(map(max, ca, cb))
        assert abs((sig[0] == sig[1]).mean() - want) < 0.04


def test_levels_and_bands():
    assert list(LEVELS[:18]) == [*range(17), 17.0]
    assert (np.diff(LEVELS) > 0).all()
    assert (LEVELS[17:] / LEVELS[16:-1]).max() < 1.07
    sig = signatures(np.arange(1, 50, dtype=np.uint64), np.array([0, 49, 49]))
    assert np.isfinite(sig[0]).all() and np.isinf(sig[1]).all()
    assert len(set(bands_of(sig)[0])) == bands_of(sig).shape[1]


def _check(docs, rows):
    """``rows``: (position, id, text) of every row, ids unique or null."""
    groups, _ = near_groups(docs)
    got = groups.collect()
    assert len(got) == len(rows)
    return got


def test_classes_equal_brute_force(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(3000)]
    rows, base = [], []
    for g in range(25):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(30, 200))]
        base.append(words)
        for c in range(rnd.choice([1, 1, 2, 6])):
            copy = list(words)
            for _ in range(rnd.choice([0, 1, 2, 4])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            rows.append(" ".join(copy))
    # a chain: neighbours similar, ends not
    words = [rnd.choice(vocab) for _ in range(150)]
    for step in range(8):
        rows.append(" ".join(words[step * 12:] + [
            f"new{i}" for i in range(step * 12)]))
    data = list(enumerate(rows))
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    want = near_classes(data)
    got = {r.id: r for r in near_groups(df)[0].collect()}
    assert {i: (r.class_id, r.group_size) for i, r in got.items()} == {
        i: (max(g), len(g)) for i, g in want.items()}
    assert all(r.kept == (i == r.class_id) for i, r in got.items())
    kept = drop_near_copies(df).collect()
    assert sorted(r.doc_id for r in kept) == sorted({max(g) for g in
                                                     want.values()})


def test_edge_rows(edge_docs):
    out = drop_near_copies(edge_docs)
    assert out.columns == edge_docs.columns
    data = edge_docs.collect()
    want = near_classes([(i, r.text) for i, r in enumerate(data)])
    sizes = sorted(len(g) for g in set(want.values()))
    got = near_groups(edge_docs)[0].collect()
    assert sorted(r.group_size for r in got if r.kept) == sizes
    assert len(got) == len(data) and out.count() == len(sizes)


def test_empty_table(no_docs):
    assert near_groups(no_docs)[0].count() == 0
    assert drop_near_copies(no_docs).columns == no_docs.columns


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101)]
    got = {r.uid: r.comp for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}


def test_common_part_and_rest_bound_the_overlap():
    rnd = random.Random(11)

    def bag():
        return np.unique(np.array([rnd.randrange(30) for _ in range(
            rnd.randint(0, 40))], np.uint64), return_counts=True)

    for _ in range(300):
        x, y, c = bag(), bag(), bag()
        rest_x, rest_y = rest_of(x, c), rest_of(y, c)
        assert len(rest_x) == x[1].sum() - overlap(x, c)
        shared = len(np.intersect1d(rest_x, rest_y))
        assert overlap(x, y) <= min(overlap(x, c), overlap(y, c)) + shared


def test_siblings_below_the_limit_cost_few_comparisons(spark, monkeypatch):
    """Copies of a lost original, mostly not similar to each other; pairs of
    them share their changes and are similar."""
    rnd = random.Random(8)
    vocab = [f"w{i}" for i in range(5000)]
    base = [rnd.choice(vocab) for _ in range(150)]
    texts = []
    for k in range(200):
        own = random.Random(k // 2 + 1000)      # two share most changes
        words = list(base)
        for _ in range(6):
            words[own.randrange(150)] = own.choice(vocab)
        for _ in range(k % 2):
            words[rnd.randrange(150)] = rnd.choice(vocab)
        texts.append((k, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    seen = []
    plain = near_dedup.written
    monkeypatch.setattr(near_dedup, "written", lambda df, name: seen.append(
        (name, plain(df, name))) or seen[-1][1])
    groups, _ = near_groups(docs)
    got = {r.id: r.class_id for r in groups.collect()}
    want = near_classes([(k, t) for k, t in texts])
    assert got == {k: max(g) for k, g in want.items()}
    compared = sum(df.count() for name, df in seen if name == "pairs")
    assert compared < 200 * 199 / 4


def test_dropping_copies_shuffles_no_text(spark):
    rows = [(i, f"{w} " * 3 + "one two three four five six seven")
            for i, w in enumerate(["x", "x", "y", "z"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = drop_near_copies(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert {0, 1} & {r.doc_id for r in kept.collect()} == {1}


def _lost_original(groups, each, changes=6, length=150):
    """Copies of lost originals; ``each`` of them share most changes."""
    rnd = random.Random(21)
    vocab = [f"w{i}" for i in range(5000)]
    rows = []
    for g in range(groups):
        words = [rnd.choice(vocab) for _ in range(length)]
        for k in range(120):
            own = random.Random(g * 1000 + k // each)
            copy = list(words)
            for _ in range(changes):
                copy[own.randrange(length)] = own.choice(vocab)
            for _ in range(k % each):
                copy[rnd.randrange(length)] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_rests_are_a_row_of_a_member_and_slot(spark, monkeypatch):
    """The hashes of rests go in lists; members of the same hashes meet once,
    and slots of a star lose no pair."""
    rows = _lost_original(2, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {k: max(g) for k, g in near_classes(rows).items()}
    met, plain = [], near_dedup.written
    monkeypatch.setattr(near_dedup, "written", lambda df, name: met.append(
        (name, plain(df, name))) or met[-1][1])
    for slot in (near_dedup.SLOT, 64):
        monkeypatch.setattr(near_dedup, "SLOT", slot)
        met.clear()
        got = near_groups(docs)[0].collect()
        assert {r.id: r.class_id for r in got} == want
        # one size class each, and no row for every hash of a rest
        rest = sum(df.selectExpr("sum(size(rest)) n").first().n or 0
                   for name, df in met if name == "rests")
        parts = sum(df.count() for name, df in met if name == "parts")
        assert rest > 0 and parts < rest / 2


def test_texts_of_other_documents_are_not_shuffled(spark, monkeypatch):
    """Pairs that are few go to the texts."""
    rows = _lost_original(1, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plans, plain = [], near_dedup.written
    monkeypatch.setattr(near_dedup, "written", lambda df, name: plans.append(
        (name, df._jdf.queryExecution().optimizedPlan().toString()))
        or plain(df, name))
    near_groups(docs)[0].collect()
    pairs = [p for name, p in plans if name == "pairs"]
    assert pairs and all("strategy=broadcast" in p for p in pairs)


def test_meetings_of_the_same_members_come_once():
    import pyarrow as pa
    rows = pa.table({
        "g": [0] * 4, "hs": [[1, 2, 3, 9], [2, 3, 1], [3, 7], [7, 8]],
        "a": [10, 11, 12, 13], "n": [5] * 4, "both": [1] * 4, "more": [4] * 4,
        "label": [1, 2, 3, 3], "seeks": [True, False, False, True]})
    got = sorted((r["h"], r["a"], r["seekers"])
                 for r in near_dedup._meetings(rows).to_pylist())
    # 1 and 2 have the same members, 7 is of one label, 8 and 9 of one member
    assert [x for x in got if x[0] == 3] == [(3, 10, 1), (3, 11, 1),
                                             (3, 12, 1)]
    assert [x[1:] for x in got if x[0] in (1, 2)] == [(10, 1), (11, 1)]
    assert len(got) == 5


def test_small_tables_take_few_tasks(spark, monkeypatch):
    """Not one for each shuffle partition, and with no other result than as
    if the tables were large."""
    rows = _lost_original(1, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {k: max(g) for k, g in near_classes(rows).items()}
    conf = {"spark.sql.shuffle.partitions": "61",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    most = 2 * spark.sparkContext.defaultParallelism
    seen, plain = [], near_dedup.written
    monkeypatch.setattr(near_dedup, "written", lambda df, name: seen.append(
        (name, plain(df, name))) or seen[-1][1])
    for large in (False, True):
        if large:
            monkeypatch.setattr(near_dedup, "FEW_ROWS", 0)
            monkeypatch.setattr(near_dedup, "TASK_ROWS", 8)
            monkeypatch.setattr(near_dedup, "TASK_TEXTS", 8)
        try:
            for k, v in conf.items():
                spark.conf.set(k, v)
            got = near_groups(docs)[0].collect()
        finally:
            for k, v in old.items():
                spark.conf.set(k, v)
        assert {r.id: r.class_id for r in got} == want
        if not large:
            assert max(len(df.inputFiles()) for name, df in seen
                       if name not in ("signed", "texts", "parts")) <= most
