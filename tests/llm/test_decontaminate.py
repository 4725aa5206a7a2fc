import hashlib
import random

import pytest

from textflow.llm.decontaminate import (find_contamination,
                                        remove_contaminated)

from .conftest import words_of


def _expected(text, items):
    w = words_of(text)
    hit, found = set(), set()
    for name, item in items:
        v = words_of(item)
        n = min(13, len(v))
        for j in range(len(v) - n + 1 if v else 0):
            for p in range(len(w) - n + 1):
                if w[p:p + n] == v[j:j + n]:
                    hit |= set(range(p, p + n))
                    if name is not None:
                        found.add(str(name))
    return (len(w), len(hit), len(found), hashlib.sha256(
        ",".join(sorted(found)).encode()).hexdigest(),
        len(hit) > 0 and 20 * len(hit) >= len(w))


def _data():
    rnd = random.Random(2)
    vocab = [f"v{i}" for i in range(60)] + ["Mixed", "café"]

    def words(n):
        return [rnd.choice(vocab) for _ in range(n)]

    items = [(i, " ".join(words(rnd.choice([13, 14, 20, 40]))))
             for i in range(12)]
    items += [(50, "Just three words"), (51, "solo"), (52, None), (53, ""),
              (None, items[0][1]), (2, items[2][1]), (54, items[3][1])]
    docs = [(1, None), (2, ""), (3, "solo"), (4, "just, THREE; words!")]
    for i in range(5, 60):
        body = words(rnd.randint(0, 120))
        for _ in range(rnd.choice([0, 1, 2])):
            src = words_of(rnd.choice(items)[1])
            lo = rnd.randint(0, max(0, len(src) - 13))
            at = rnd.randint(0, len(body))
            body[at:at] = src[lo:lo + rnd.choice([5, 12, 13, 16, 60])]
        docs.append((i, " ".join(body)))
    docs += [(60, docs[10][1]), (60, docs[10][1])]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 24, 400])
def test_equals_brute_force(spark, block_bytes):
    docs, items = _data()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = find_contamination(d, b, block_bytes=block_bytes).collect()
    assert len(got) == len(docs)
    want = {i: _expected(t, items) for i, t in docs}
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256,
                r.contaminated) == want[r.row.doc_id], r.row.doc_id


def test_longest_matches_and_places(spark):
    item = " ".join(f"w{i}" for i in range(30))
    text = "x y " + " ".join(f"w{i}" for i in range(4, 25)) + " z"
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    b = spark.createDataFrame([("q", item)], "item_id string, text string")
    r = find_contamination(d, b).first()
    assert [m.asDict() for m in r.matches] == [
        {"item_id": "q", "item_pos": 4, "doc_pos": 2, "n_words": 21}]
    assert [(s.start, s.end) for s in r.spans] == [(2, 23)]


def test_whole_rows_stay(spark, edge_docs, no_docs):
    b = spark.createDataFrame([(1, "only four words here")],
                              "item_id long, text string")
    out = remove_contaminated(edge_docs, b)
    assert out.columns == edge_docs.columns
    gone = {5, 6}
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(
        str(r.doc_id) for r in edge_docs.collect() if r.doc_id not in gone)
    assert remove_contaminated(no_docs, b).count() == 0
    empty = b.filter("item_id < 0")
    assert remove_contaminated(edge_docs, empty).count() == edge_docs.count()
