import random
import re

import pyarrow as pa
import regex

from textflow.llm.words import LETTERS, chunk_runs, word_runs

from .conftest import words_of

PARTS = ["a", "Bc", "9", " ", "  ", "\n", "\t", "é", "'s", "'", "-", "_", "\x00",
         "日本", "😀", ".", "\x85", "x1y2", ""]


def _texts(n, seed):
    rnd = random.Random(seed)
    return [None if rnd.random() < .05 else "".join(
        rnd.choice(PARTS) for _ in range(rnd.randint(0, 25)))
        for _ in range(n)]


def test_words_are_the_regex_words():
    texts = _texts(3000, 1)
    got, by_hash = {}, {}
    for r in word_runs(pa.array(texts)):
        for i in range(r.rows):
            own = []
            for k in range(r.ptr[i], r.ptr[i + 1]):
                w = r.text(k).decode()
                own.append(w)
                assert by_hash.setdefault(int(r.hash[k]), w) == w
            got[r.first + i] = own
    assert [got[i] for i in range(len(texts))] == [words_of(t) for t in texts]
    assert len(set(by_hash.values())) == len(by_hash)


def test_sliced_and_empty_arrays():
    a = pa.array(["x y", None, "z w v", "q"])
    r = next(word_runs(a.slice(2)))
    assert [r.text(i) for i in range(len(r.start))] == [b"z", b"w", b"v", b"q"]
    assert list(word_runs(pa.array([], pa.string()))) == []


def test_letters_leave_digits_out():
    r = next(word_runs(pa.array(["ab1cd 22"]), LETTERS))
    assert [r.text(i) for i in range(len(r.start))] == [b"ab", b"cd"]


def test_chunks_split_only_where_both_patterns_split():
    texts = [t or "" for t in _texts(3000, 2)]
    import public_tokenizers
    byte_level = regex.compile(public_tokenizers.PATTERN)
    for r in chunk_runs(pa.array(texts), False, True):
        for i in range(r.rows):
            chunks = [r.text(k).decode() for k in range(r.ptr[i],
                                                        r.ptr[i + 1])]
            t = texts[r.first + i]
            assert "".join(chunks) == t
            assert [p for c in chunks for p in byte_level.findall(c)
                    ] == byte_level.findall(t)
    for r in chunk_runs(pa.array(texts), False, False):
        for i in range(r.rows):
            chunks = [r.text(k).decode() for k in range(r.ptr[i],
                                                        r.ptr[i + 1])]
            assert re.sub(r"[ \t-\r]", "", texts[r.first + i]
                          ) == "".join(chunks)
