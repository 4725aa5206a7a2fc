"""Chunks of BIO labels against plain Python; tokens outside stay at home."""

import random

from textflow.operators import sequence
from textflow.plans import lineage

LABELS = ["O", "O", "O", None, "B-PER", "I-PER", "B-LOC", "I-LOC"]


def chunks(labels):
    out, start, kind = [], None, None
    for i, x in enumerate([*labels, "O"], 1):
        typ = x[2:] if x and x != "O" else None
        if kind and (typ != kind or x[0] == "B"):
            out.append((start, i - 1, kind))
            kind = None
        if typ and not kind:
            start, kind = i, typ
    return out


def test_two_columns_in_one_pass(spark):
    rnd = random.Random(3)
    texts = {d: [(rnd.choice(LABELS), rnd.choice(LABELS)) for _ in range(n)]
             for d, n in enumerate([0, 1, 2, 40, 300])}
    # runs over the edge of a block of positions
    texts[9] = [("O", "O")] * 8189 + [("B-PER", "O"), ("I-PER", "I-LOC")] + [
        ("I-PER", "I-LOC")] * 3 + [("O", None)] * 8190 + [("I-LOC", "O")]
    t = spark.createDataFrame(
        [(d, p, g, q) for d, ls in texts.items()
         for p, (g, q) in enumerate(ls, 1)],
        "sent_id long, pos long, gold string, pred string").repartition(5)
    spans = sequence.bio_spans(t, ["gold", "pred"])
    got = sorted((r.sent_id, r.labels, r.start, r.end, r.type)
                 for r in spans.collect())
    assert got == sorted((d, c, *x) for d, ls in texts.items()
                         for i, c in enumerate(("gold", "pred"))
                         for x in chunks([p[i] for p in ls]))
    one = {(r.sent_id, r.start, r.end, r.type)
           for r in sequence.bio_spans(t, "pred").collect()}
    assert one == {(d, s, e, k) for d, c, s, e, k in got if c == "pred"}


def test_neighbours_are_looked_up_once(spark, monkeypatch):
    """Of the tokens inside of chunks, for all labels in one pass."""
    written = []
    monkeypatch.setattr(lineage, "OBSERVERS", [written.append])
    t = spark.createDataFrame([(1, 1, "O", "O")], "sent_id long, pos long, "
                              "gold string, pred string")
    sequence.bio_spans(t, ["gold", "pred"])
    events, = written
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and "isnotnull(coalesce" in plan
