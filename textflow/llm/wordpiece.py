"""The word-end BPE of a tokenizers JSON file, chunk by chunk.

The library lower-cases, normalises to NFC, drops white space and splits at
letter runs, single digits and punctuation runs.  Chunks from
``words.chunk_runs`` end only where it certainly splits, so encoding chunks
one by one gives the ids of the whole text.  Texts that hold an added token
(``<|...|>``) are encoded whole, because the library takes those strings
before it splits.
"""

from __future__ import annotations

import os
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc

from textflow.llm.memo import ChunkMemo

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@lru_cache(maxsize=2)
def library(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def added_tokens(path: str) -> tuple[str, ...]:
    return tuple(t.content for t in
                 library(path).get_added_tokens_decoder().values())


def encode_whole(path: str, text: str) -> list[int]:
    return library(path).encode(text, add_special_tokens=False).ids


_JOIN = 256


@lru_cache(maxsize=2)
def chunk_memo(path: str) -> ChunkMemo:
    tok = library(path)
    ends = [False] * tok.get_vocab_size(with_added_tokens=True)
    for piece, i in tok.get_vocab(with_added_tokens=True).items():
        ends[i] = piece.endswith("</w>")

    def encode(chunks: list[bytes]) -> list[list[int]]:
        texts = [c.decode("utf-8") for c in chunks]
        out: list[list[int] | None] = [None] * len(texts)
        # chunks of ASCII letters are one word each: many are encoded as
        # one text and told apart by their word-end tokens
        plain = [i for i, t in enumerate(texts)
                 if t.isascii() and t.isalpha()]
        groups = [plain[k:k + _JOIN] for k in range(0, len(plain), _JOIN)]
        joined = tok.encode_batch_fast(
            [" ".join([texts[i] for i in g]) for g in groups],
            add_special_tokens=False)
        for g, enc in zip(groups, joined, strict=True):
            parts, word = [], []
            for t in enc.ids:
                word.append(t)
                if ends[t]:
                    parts.append(word)
                    word = []
            if len(parts) == len(g) and not word:
                for i, p in zip(g, parts, strict=True):
                    out[i] = p
        rest = [i for i, o in enumerate(out) if o is None]
        for i, e in zip(rest, tok.encode_batch_fast(
                [texts[i] for i in rest], add_special_tokens=False),
                strict=True):
            out[i] = e.ids
        return out

    return ChunkMemo(encode)


def has_added(texts: pa.Array, path: str) -> list[bool]:
    """Which rows hold the string of an added token."""
    found = None
    for t in added_tokens(path):
        f = pc.match_substring(texts, t)
        found = f if found is None else pc.or_(found, f)
    if found is None:
        return [False] * len(texts)
    return pc.fill_null(found, False).to_pylist()
