"""Token counts by the whole-token shortcut.

Offline, on the driver, every vocabulary string that can stand as a word is
given to the library alone; those that come back as exactly one token are
*proven*.  The proof table has at most one 8-byte hash per vocabulary entry.
In the tasks a chunk in the table counts one without any merging; only the
rest is merged by the library, once per distinct chunk and worker.

Null counts as empty.  Repeated rows are counted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.llm.words import Runs, chunk_runs
from textflow.llm.wordpiece import (chunk_memo, encode_whole, has_added,
                                    library)

WORD_END = "</w>"


def _byte_of_char() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    for the characters from U+0100 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in shown}
    rest = [b for b in range(256) if b not in set(shown)]
    return table | {chr(256 + i): b for i, b in enumerate(rest)}


def proven_words(path: str) -> np.ndarray:
    """Sorted chunk hashes of the strings proven to be one token alone."""
    tok, back = library(path), _byte_of_char()
    words = []
    for piece in tok.get_vocab(with_added_tokens=False):
        if not piece.endswith(WORD_END):
            continue
        raw = bytes(back[c] for c in piece[:-len(WORD_END)])
        try:
            words.append(raw.decode("utf-8"))
        except UnicodeDecodeError:
            continue
    alone = tok.encode_batch_fast(words, add_special_tokens=False)
    single = [w for w, e in zip(words, alone, strict=True)
              if len(e.ids) == 1]
    hashes = [np.zeros(0, np.uint64)]
    for r in chunk_runs(pa.array(single, pa.string()), True, False):
        one = np.diff(r.ptr) == 1       # the string is one chunk
        hashes.append(r.hash[r.ptr[:-1][one]])
    return np.unique(np.concatenate(hashes))


def _rest(runs: Runs, keep: np.ndarray) -> Runs:
    upto = np.concatenate([[0], np.cumsum(keep)])
    return Runs(runs.first, runs.buf, runs.start[keep], runs.end[keep],
                runs.hash[keep], upto[runs.ptr], runs.off)


def _pass(path: str, proven, like: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, memo = proven.value, chunk_memo(path)
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            n_bytes, n_tokens, direct = [], [], []
            for r in chunk_runs(texts, True, False):
                at = np.searchsorted(table, r.hash)
                at[at == len(table)] = 0
                hit = table[at] == r.hash if len(table) else np.zeros(
                    len(r.hash), bool)
                upto = np.concatenate([[0], np.cumsum(hit)])
                own = np.diff(upto[r.ptr])
                n_tokens.append(own + memo.counts(_rest(r, ~hit)))
                direct.append(own)
                n_bytes.append(np.diff(r.off))
            if not n_tokens:
                continue
            n = np.concatenate(n_tokens)
            d = np.concatenate(direct)
            for i, special in enumerate(has_added(texts, path)):
                if special:
                    n[i] = len(encode_whole(path, texts[i].as_py()))
                    d[i] = 0
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.concatenate(n_bytes), pa.int64()),
                 pa.array(n, pa.int64()), pa.array(d, pa.int64())],
                schema=like)

    return run


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens, n_direct`` of every row; ``n_direct`` is the
    number of words that needed no merging."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("n_direct", T.LongType())])
    proven = spark.sparkContext.broadcast(proven_words(tokenizer))
    return docs.select(id_col, text_col).mapInArrow(
        _pass(tokenizer, proven, to_arrow_schema(schema)), schema)


LIMIT_TOKENS = 2048


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from textflow.llm.stage import documents
    counts = count_tokens(documents(spark, sf_dir),
                          public_tokenizers.path("word_bpe_49k.json"))
    return counts.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                         (F.col("n_tokens") > LIMIT_TOKENS)
                         .alias("over_limit"))
