"""Language identification by a linear-chain conditional random field.

Every word of a sentence gets a language label; neighbours are tied by
learned transitions, and forward-backward gives each word's probabilities,
so text that changes language inside a document or a sentence is labelled
word by word.  A document's language is the one with the largest mean word
probability; the mean is its score.

Word features: the word, its affixes, its byte trigrams (all hashed into
one weight table) and the lexicons of words seen repeatedly in the training
sentences of each language.

The model is fitted on a bounded sample of labelled rows: at most
``SAMPLE_DOCS`` documents of ``SAMPLE_BYTES`` bytes at most per language (a
window of longer ones), those with the smallest hashes.  Part of the training sentences are joined
from different languages so that switches are learned.  Prediction covers
every word of every row.

Words are runs of ASCII letters and non-ASCII bytes, sentences end at line
ends and ``.!?``.  A text that is null or has no letter is ``und`` with
score 0, and so is every text if no row is labelled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.llm.words import LETTERS, Runs, mix, ranges, spread, word_runs

SAMPLE_DOCS = 150
SAMPLE_BYTES = 20_000
TABLE_BITS = 18
EPOCHS = 4
BATCH_SENTENCES = 1500
RATE = 0.3
DECAY = 1e-4
SWITCHED = 0.25         # share of training sentences joined from two
UNKNOWN = "und"

_STOP = np.zeros(256, np.int32)
_STOP[[ord(c) for c in "\n.!?"]] = 1


def sentence_starts(r: Runs) -> np.ndarray:
    """Run numbers at which a sentence begins."""
    if not len(r.start):
        return np.zeros(0, np.int64)
    stops = np.concatenate([[0], np.cumsum(_STOP[r.raw])])
    new = np.ones(len(r.start), bool)
    new[1:] = stops[r.start[1:]] > stops[r.end[:-1]]
    first = r.ptr[:-1][np.diff(r.ptr) > 0]
    new[first] = True
    return np.flatnonzero(new)


def word_features(r: Runs, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, count per word) of the runs ``at``."""
    from textflow.llm.words import _powers

    pre, (_, inv) = r.prefix(), _powers(len(r.buf) + 1)
    start, end = r.start[at], r.end[at]
    size = end - start
    part = (lambda a, b: (pre[b] - pre[a]) * inv[a])
    cols = [r.hash[at]]
    for n in (1, 2, 3):
        cols.append(mix(part(start, start + np.minimum(n, size))
                        + np.uint64(n)))
    for n in (1, 2, 3, 4):
        cols.append(mix(part(end - np.minimum(n, size), end)
                        + np.uint64(16 + n)))
    fixed = np.stack(cols, 1)
    grams = np.maximum(size - 2, 0)
    a = ranges(start, grams)
    tri = mix(part(a, a + 3) + np.uint64(64))
    count = fixed.shape[1] + grams
    out = np.zeros(int(count.sum()), np.uint64)
    first = np.cumsum(count) - count
    out[(first[:, None] + np.arange(fixed.shape[1])).ravel()] = fixed.ravel()
    out[ranges(first + fixed.shape[1], grams)] = tri
    return (out >> np.uint64(64 - TABLE_BITS)).astype(np.int64), count


@dataclass
class Model:
    langs: list[str]
    weight: np.ndarray          # features x languages
    lexicon: np.ndarray         # sorted word hashes
    listed: np.ndarray          # lexicon x languages, 0/1
    lexical: np.ndarray         # languages x languages
    trans: np.ndarray           # languages x languages

    def lexicon_rows(self, hashes: np.ndarray) -> np.ndarray:
        k = len(self.langs)
        if not len(self.lexicon):
            return np.zeros((len(hashes), k), np.float32)
        at = np.searchsorted(self.lexicon, hashes)
        at[at == len(self.lexicon)] = 0
        known = self.lexicon[at] == hashes
        return self.listed[at] * known[:, None].astype(np.float32)

    def scores(self, flat: np.ndarray, count: np.ndarray,
               lex: np.ndarray) -> np.ndarray:
        """Languages' scores of words given by their features."""
        first = np.cumsum(count) - count
        s = np.add.reduceat(self.weight[flat], first, axis=0) if len(
            count) else np.zeros((0, len(self.langs)), np.float32)
        return s + lex @ self.lexical


def forward_backward(emit: np.ndarray, trans: np.ndarray, start: np.ndarray,
                     size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward and backward vectors of many chains at once.

    ``emit``: positive, words x labels; chain i is words ``start[i]`` to
    ``start[i] + size[i]``.  Chains are taken longest first, so step t works
    on the chains that have a t-th word.
    """
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    alpha, beta = np.empty_like(emit), np.empty_like(emit)
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(longest), "left")
    for t in range(longest):
        at = start[:alive[t]] + t
        a = emit[at] if t == 0 else (alpha[at - 1] @ trans) * emit[at]
        alpha[at] = a / a.sum(1, keepdims=True)
    back = trans.T.copy()
    if len(size):
        beta[start + size - 1] = 1.0
    for t in range(longest - 2, -1, -1):
        at = start[:alive[t + 1]] + t
        b = (emit[at + 1] * beta[at + 1]) @ back
        beta[at] = b / b.sum(1, keepdims=True)
    return alpha, beta


def _positive(scores: np.ndarray) -> np.ndarray:
    s = scores.astype(np.float64)
    return np.exp(np.maximum(s - s.max(1, keepdims=True), -60.0))


def fit(texts: pa.Array, labels: list[str], seed: int = 7) -> Model:
    """CRF weights by Adagrad on the conditional log-likelihood."""
    langs = sorted(set(labels))
    k = len(langs)
    number = {x: i for i, x in enumerate(langs)}
    doc_lang = np.array([number[x] for x in labels], np.int64)
    hashes, feats, counts, sent_word, sent_lang = [], [], [], [], []
    base = 0
    for r in word_runs(texts, LETTERS):
        f, c = word_features(r, np.arange(len(r.start)))
        hashes.append(r.hash)
        feats.append(f)
        counts.append(c)
        s = sentence_starts(r)
        doc = np.searchsorted(r.ptr, s, "right") - 1
        sent_word.append(s + base)
        sent_lang.append(doc_lang[r.first + doc])
        base += len(r.start)
    model = Model(langs, np.zeros((1 << TABLE_BITS, k), np.float32),
                  np.zeros(0, np.uint64), np.zeros((0, k), np.float32),
                  np.zeros((k, k), np.float32), np.zeros((k, k)))
    if not base or not k:
        return model
    words = np.concatenate(hashes)
    flat, count = np.concatenate(feats), np.concatenate(counts)
    begin = np.concatenate(sent_word)
    lang = np.concatenate(sent_lang)
    size = np.diff(np.append(begin, base))
    gold = np.repeat(lang, size)
    # word types: features once per distinct word
    types, first, inv = np.unique(words, return_index=True,
                                  return_inverse=True)
    at = np.cumsum(count) - count
    t_count = count[first]
    t_flat = flat[ranges(at[first], t_count)]
    t_at = np.cumsum(t_count) - t_count
    # lexicons: words seen at least twice in a language
    seen = np.zeros((len(types), k), np.int64)
    np.add.at(seen, (inv, gold), 1)
    listed = (seen >= 2).any(1)
    model.lexicon = types[listed]
    model.listed = (seen[listed] >= 2).astype(np.float32)
    lex = model.lexicon_rows(types)

    rng = np.random.default_rng(seed)
    sq_w = np.full(model.weight.shape, 1e-6, np.float32)
    sq_l = np.full((k, k), 1e-6)
    sq_t = np.full((k, k), 1e-6)
    for _ in range(EPOCHS):
        perm = rng.permutation(len(begin))
        for lo in range(0, len(perm), BATCH_SENTENCES):
            s = perm[lo:lo + BATCH_SENTENCES]
            n = size[s]
            tok = ranges(begin[s], n)
            # some neighbours in the batch become one code-switched chain
            joined = rng.random(len(s)) < SWITCHED
            joined[0] = False
            c_start = (np.cumsum(n) - n)[~joined]
            c_size = np.diff(np.append(c_start, len(tok)))
            types_in, back = np.unique(inv[tok], return_inverse=True)
            f_count = t_count[types_in]
            f = t_flat[ranges(t_at[types_in], f_count)]
            lx = lex[types_in]
            emit = _positive(model.scores(f, f_count, lx))[back]
            move = np.exp(model.trans)
            alpha, beta = forward_backward(emit, move, c_start, c_size)
            prob = alpha * beta
            prob /= prob.sum(1, keepdims=True)
            y = gold[tok]
            err = -prob
            err[np.arange(len(y)), y] += 1.0
            g_type = np.zeros((len(types_in), k), np.float32)
            np.add.at(g_type, back, err.astype(np.float32))
            uf, fb = np.unique(f, return_inverse=True)
            g = np.zeros((len(uf), k), np.float32)
            np.add.at(g, fb, g_type[spread(f_count)])
            g -= DECAY * len(s) * model.weight[uf]
            sq_w[uf] += g * g
            model.weight[uf] += RATE * g / np.sqrt(sq_w[uf])
            g_l = lx.T @ g_type - DECAY * len(s) * model.lexical
            sq_l += g_l * g_l
            model.lexical += (RATE * g_l / np.sqrt(sq_l)).astype(np.float32)
            later = np.ones(len(tok), bool)
            later[c_start] = False
            at_t = np.flatnonzero(later)
            pair = (alpha[at_t - 1][:, :, None] * move
                    * (emit[at_t] * beta[at_t])[:, None, :])
            pair /= pair.sum((1, 2), keepdims=True)
            g_t = -pair.sum(0) - DECAY * len(s) * model.trans
            np.add.at(g_t, (y[at_t - 1], y[at_t]), 1.0)
            sq_t += g_t * g_t
            model.trans += RATE * g_t / np.sqrt(sq_t)
    return model


def label_piece(model: Model, r: Runs) -> np.ndarray:
    """Probabilities (words x languages) of all words of a piece."""
    types, first, inv = np.unique(r.hash, return_index=True,
                                  return_inverse=True)
    flat, count = word_features(r, first)
    emit = _positive(model.scores(flat, count,
                                  model.lexicon_rows(types)))[inv]
    begin = sentence_starts(r)
    size = np.diff(np.append(begin, len(r.start)))
    alpha, beta = forward_backward(emit, np.exp(model.trans), begin, size)
    prob = alpha * beta
    return prob / prob.sum(1, keepdims=True)


SEGMENT = (T.StructType().add("lang", T.StringType())
           .add("n_words", T.LongType()))


def _segments(best: np.ndarray, langs: list[str]) -> list[dict]:
    if not len(best):
        return []
    cut = np.flatnonzero(np.diff(best)) + 1
    begin = np.concatenate([[0], cut])
    size = np.diff(np.append(begin, len(best)))
    return [{"lang": langs[b], "n_words": int(n)}
            for b, n in zip(best[begin], size, strict=True)]


def _pass(model, text_col: str, segments: bool, like: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            row = b.column(0)
            texts = row.field(text_col).cast(pa.large_string())
            letter = pc.fill_null(pc.match_substring_regex(
                texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            for r in word_runs(texts, LETTERS):
                n = r.rows
                words = np.diff(r.ptr)
                pred, score = [UNKNOWN] * n, np.zeros(n)
                parts = [[] for _ in range(n)]
                if m.langs and len(r.start):
                    prob = label_piece(m, r)
                    full = np.flatnonzero(words > 0)
                    mean = (np.add.reduceat(prob, r.ptr[:-1][full], axis=0)
                            / words[full][:, None])
                    best = mean.argmax(1)
                    word_best = prob.argmax(1) if segments else None
                    for i, row_no in enumerate(full):
                        if not letter[r.first + row_no]:
                            continue
                        pred[row_no] = m.langs[best[i]]
                        score[row_no] = min(1.0, mean[i, best[i]])
                        if segments:
                            parts[row_no] = _segments(
                                word_best[r.ptr[row_no]:r.ptr[row_no + 1]],
                                m.langs)
                cols = [row.slice(r.first, n), pa.array(pred),
                        pa.array(score)]
                if segments:
                    cols.append(pa.array(parts, like.field(3).type))
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(cols, like,
                                                    strict=True)],
                    schema=like)

    return run


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", per_lang: int = SAMPLE_DOCS) -> Model:
    """Fit on the bounded sample of labelled rows of ``docs``; of a text of
    more than ``SAMPLE_BYTES``, on a window from its first letter on."""
    key = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    window = F.regexp_extract(
        text_col, r"(?s)\p{L}.{0,%d}" % (SAMPLE_BYTES // 4 - 1), 0)
    rows = docs.filter(F.col(lang_col).isNotNull()
                       & F.col(text_col).rlike(r"\p{L}")
                       & ~held_out(id_col))
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    if not counts:
        return fit(pa.array([], pa.string()), [])
    # about 8 x per_lang rows of each language have a key this small
    share = F.create_map(*[x for lang, n in counts.items() for x in (
        F.lit(lang), F.lit(min(1.0, 8.0 * per_lang / n)))])
    few = rows.select(F.col(lang_col).alias("lang"),
                      F.when(F.octet_length(text_col) <= SAMPLE_BYTES,
                             F.col(text_col)).otherwise(window).alias("text"),
                      key.alias("key")).filter(
        F.shiftrightunsigned("key", 11) * 2.0 ** -53 <= share[F.col("lang")])
    w = Window.partitionBy("lang").orderBy("key", "text")
    sample = (few.withColumn("r", F.row_number().over(w))
              .filter(F.col("r") <= per_lang).select("lang", "key", "text")
              .toArrow().sort_by([("lang", "ascending"),
                                  ("key", "ascending")]))
    return fit(sample["text"].combine_chunks(), sample["lang"].to_pylist())


def predict(docs: DataFrame, model: Model, text_col: str = "text",
            carry=None, segments: bool = True) -> DataFrame:
    """``row`` (struct of the columns in ``carry``, default all),
    ``lang_pred``, ``score`` and, if asked for, ``segments``: the languages
    of the text in order with their numbers of words."""
    from pyspark.sql.pandas.types import to_arrow_schema

    carry = docs.columns if carry is None else list(carry)
    cols = list(dict.fromkeys([*carry, text_col]))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols])
                         .alias("row"))
    schema = T.StructType([packed.schema["row"],
                           T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    if segments:
        schema = schema.add("segments", T.ArrayType(SEGMENT))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return packed.mapInArrow(_pass(shared, text_col, segments,
                                   to_arrow_schema(schema)), schema)


def op10_lang_id(spark, sf_dir: str) -> DataFrame:
    from textflow.llm.stage import documents
    docs = documents(spark, sf_dir)
    model = train(docs)
    out = predict(docs.select("doc_id", "text"), model, segments=False)
    return out.select(F.col("row.doc_id").alias("doc_id"),
                      held_out("row.doc_id").alias("held_out"),
                      "lang_pred", "score")
