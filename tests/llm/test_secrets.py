import hashlib
import math
import random
import re

from textflow.llm.queries import REGISTRY
from textflow.llm.secrets import Automaton, scan_secrets

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def _base(text):
    t = text or ""
    out = [(m.start(), 0, f"assign:{m.start()}:{m.end()}")
           for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}")
            for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}")
            for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return [s for _, _, s in sorted(out)]


def _digest(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def _hex(rnd, n=40):
    return "".join(rnd.choice("0123456789abcdef") for _ in range(n))


def _key(rnd):
    return "AKIA" + "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
                            for _ in range(16))


def test_base_spans_equal_brute_force_and_formats_are_found(spark):
    rnd = random.Random(9)
    parts = ["token = ", "PassWord: '", "api_key=\"", "API KEY=", "ſecret=abcdef",
             "secret=abc", "AKIA", "AKIA" + "Z" * 15, "abcdef12", "é ", "\n",
             "😀", "the quick ", "passwd=token=abcdef", "-", "0" * 24]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))))
            for i in range(400)]
    rows += [(1000 + i, f"My token = {_hex(rnd)} and {_key(rnd)}.")
             for i in range(60)]
    rows += [(2000, None), (2001, ""), (2002, "x " * 50_000 + _key(rnd)),
             (2003, "a"), (2003, "a"), (None, "secret: hunter22")]
    # an upper-case digest is the format of the keys, of no base pattern
    rows += [(3000, "it was B" + _key(rnd)[1:] + " here"),
             (3001, "plainword extraordinarily 2024-01-01T00:00:00")]
    df = spark.createDataFrame([(*r, "s") for r in rows],
                               "doc_id long, text string, spans string")
    got = scan_secrets(df).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        want[i] = _base(t)
    for r in got:
        base = want[r.id]
        assert r.base_sha256 == _digest(base), r.id
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(s.startswith(k) for s in base)
            for k in ("assign", "access", "hex"))
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("inferred")] == base
    assert {r.id: r.spans for r in got}[3001] == ""


def test_automaton_generalises_a_format():
    rnd = random.Random(1)
    a = Automaton([_hex(rnd) for _ in range(300)])
    reached, todo = {0}, [0]
    while todo:
        new = set(a.next[todo.pop()].values()) - reached
        reached |= new
        todo += new
    assert len(reached) < 20
    seen = [a.log_likelihood(_hex(rnd)) for _ in range(50)]
    assert sum(s is not None for s in seen) > 40
    assert all(s is None or s <= 0 for s in seen)
    assert a.log_likelihood("Hello, World") is None


def test_automaton_keeps_what_differs():
    a = Automaton(["0z"] * 200 + ["a+"] * 200)
    assert a.log_likelihood("0z") is not None
    assert a.log_likelihood("a+") is not None
    assert a.log_likelihood("0+") is None and a.log_likelihood("0") is None
    assert abs(a.log_likelihood("0z") - math.log(.5)) < .2


def test_tables_without_secrets(spark, no_docs, edge_docs):
    assert scan_secrets(no_docs).count() == 0
    got = scan_secrets(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert all(r.spans == "" for r in got)


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(
        f"{sf}/documents.parquet").collect()}
    got = REGISTRY["op9_secret_scan"](spark, sf).collect()
    assert len(got) == len(docs)
    assert all(r.base_sha256 == _digest(_base(docs[r.doc_id])) for r in got)
