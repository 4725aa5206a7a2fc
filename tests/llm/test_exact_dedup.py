import hashlib
from collections import defaultdict

import pytest

from textflow.llm.exact_dedup import (ContentTable, assign_groups,
                                      content_key, drop_copies)

from .conftest import ascii_lower


def _expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[ascii_lower(t or "")].append(i)
    return {t: (max((i for i in ids if i is not None), default=None),
                len(ids)) for t, ids in groups.items()}


@pytest.mark.parametrize("table_bytes", [1 << 26, 3000])
def test_groups_equal_brute_force(spark, edge_docs, table_bytes):
    # the small budget hands tables on early and spills to further levels
    want = _expected([(r.doc_id, r.text) for r in edge_docs.collect()])
    got = assign_groups(edge_docs, table_bytes=table_bytes).collect()
    assert len(got) == edge_docs.count()
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): v
              for t, v in want.items()}
    kept = defaultdict(int)
    for r in got:
        assert (r.keep_id, r.group_size) == by_sha[r.text_sha256]
        if r.kept:
            assert r.id == r.keep_id
            kept[r.text_sha256] += 1
    assert set(kept.values()) == {1} and set(kept) == set(by_sha)


def test_drop_copies_keeps_whole_rows(edge_docs):
    out = drop_copies(edge_docs, table_bytes=3000)
    assert out.columns == edge_docs.columns
    rows = out.collect()
    want = _expected([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert sorted(((r.doc_id, ascii_lower(r.text or "")) for r in rows),
                  key=repr) == sorted(((v[0], t) for t, v in want.items()),
                                      key=repr)
    assert all(r.kept == "k" and r.row == "r" for r in rows)


def test_hot_group_leaves_each_task_as_one_class(spark):
    df = spark.range(3000, numPartitions=6).selectExpr(
        "id as doc_id", "if(id % 3 = 0, 'Hot text', concat('t', id)) as text")
    rows = assign_groups(df).filter("group_size > 1").collect()
    assert len(rows) == 1000 and {r.keep_id for r in rows} == {2997}
    assert sum(r.kept for r in rows) == 1


def test_empty_table(no_docs):
    assert assign_groups(no_docs).count() == 0
    assert drop_copies(no_docs).columns == no_docs.columns


def test_open_addressing_compares_contents():
    t = ContentTable()
    words = [str(i).encode() for i in range(5000)]
    for w in words:
        assert t.find(7, w) < 0 or len(t) == 0     # all hashes collide
        if len(t) < 50:
            t.add(7, w)
    assert [t.find(7, w) for w in words[:50]] == list(range(50))
    t = ContentTable()
    for w in words:
        t.add(content_key(w), w)
    assert all(t.find(content_key(w), w) == i for i, w in enumerate(words))
