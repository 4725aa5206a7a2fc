import random
import re
from collections import Counter

import pytest

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def words_of(text) -> list[str]:
    return WORD.findall(ascii_lower(text or ""))


def bag_of(text, k: int = 5) -> Counter:
    w = words_of(text)
    return Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))
                   ) if w else Counter()


def similar(a: Counter, b: Counter) -> bool:
    both = sum(min(c, b[g]) for g, c in a.items() if g in b)
    return both > 0 and 5 * both >= 4 * (a.total() + b.total() - both)


def near_classes(rows) -> dict:
    """uid -> frozenset of uids by brute force over (uid, text)."""
    parent = {u: u for u, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [(u, bag_of(t), ascii_lower(t or "")) for u, t in rows]
    for i, (u, a, s) in enumerate(bags):
        for v, b, t in bags[i + 1:]:
            if s == t or similar(a, b):
                parent[find(u)] = find(v)
    groups = {}
    for u, _ in rows:
        groups.setdefault(find(u), []).append(u)
    return {u: frozenset(g) for g in groups.values() for u in g}


#: columns that clash with names the operators use themselves
CLASH = ("row string, kept string, uid string, key string, lang_pred string, "
         "class_id string")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, odd bytes."""
    rnd = random.Random(5)
    vocab = ["".join(rnd.choice("abcdehilnorst") for _ in range(
        rnd.randint(1, 9))) for _ in range(400)]
    long_text = " ".join(rnd.choice(vocab) for _ in range(60_000))
    prose = [" ".join(rnd.choice(vocab) for _ in range(120))
             for _ in range(6)]
    texts = [
        (1, None), (2, ""), (3, "   "), (4, "!!!"), (5, "Only Four words here"),
        (6, "only four WORDS here"), (7, prose[0]), (8, prose[0].upper()),
        (9, prose[0] + " tail"), (10, prose[1]), (10, prose[1]),
        (10, prose[2]), (None, prose[3]), (None, None), (13, prose[3]),
        (14, long_text), (15, long_text + " x"), (16, "café \U0001F600 中文"),
        (17, "a " * 3000), (18, "a " * 3001), (19, "line\r\nline\tx\x00y"),
        (20, prose[4].replace(" ", "\n")), (21, prose[4]),
        (22, "don't it's we'll <|endoftext|> 12345"),
    ]
    rows = [(i, t, "en" if i is None or i % 2 else None, "r", "k", "u", "y",
             "l", "c") for i, t in texts]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, " + CLASH
    ).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, "
                                 + CLASH)
