"""Word vectors, analogies and document vector features.

Vector tables are ``(word, vec ARRAY<FLOAT>)``.  Documents are joined to the
table on the word (AQE broadcasts a small table or splits hot words);
per-document averages are worked out inside shards of documents, to which each
text is sent once and each vector once for a shard that needs it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from textflow.functions.text import cap_code
from textflow.plans.lineage import cut_lineage


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0),
                       lambda acc, x: acc + x)


def _norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def as_double(vec: Column | str) -> Column:
    v = F.col(vec) if isinstance(vec, str) else vec
    return F.transform(v, lambda x: x.cast("double"))


def word2vec(token_arrays: DataFrame, words: str = "words",
             vector_size: int = 300, window: int = 13, min_count: int = 9,
             seed: int = 42, max_iter: int = 1, partitions: int | None = None
             ) -> DataFrame:
    """V1: train word vectors (MLlib skip-gram); ``(word, vec)``."""
    from pyspark.ml.feature import Word2Vec
    w2v = Word2Vec(vectorSize=vector_size, windowSize=window,
                   minCount=min_count, seed=seed, maxIter=max_iter,
                   inputCol=words, outputCol="_v")
    if partitions:
        w2v.setNumPartitions(partitions)
    model = w2v.fit(token_arrays)
    return model.getVectors().select(
        "word", vector_to_array("vector", "float32").alias("vec"))


def analogy(vectors: DataFrame, positive: Column, negative: Column,
            k: int = 10, word: str = "word", vec: str = "vec") -> DataFrame:
    """V2: ``most_similar(positive, negative)``.

    Query = mean of the unit vectors of the query words (+1 / -1); score =
    cosine to it; the query words are excluded; top ``k`` by score, ties by
    word.  ``positive``/``negative`` are array columns of words.  The query
    vector is a scalar subquery (one vector) attached to every row, so the
    scan needs no join and no shuffle before the final top-k.
    """
    unit = (vectors.select(word, as_double(vec).alias("_v"))
            .withColumn("_n", _norm(F.col("_v")))
            .withColumn("_u", F.transform("_v", lambda x: x / F.col("_n"))))
    q = unit.filter(F.array_contains(positive, F.col(word)) |
                    F.array_contains(negative, F.col(word)))
    q = q.select(F.posexplode("_u").alias("_i", "_x"), F.when(
        F.array_contains(positive, F.col(word)), 1.0).otherwise(-1.0)
        .alias("_s"))
    n_words = F.size(positive) + F.size(negative)
    q = q.groupBy("_i").agg((F.sum(F.col("_x") * F.col("_s")) / n_words)
                            .alias("_m"))
    qvec = q.agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))),
                             lambda s: s["_m"])).scalar()
    scored = (unit.filter(~(F.array_contains(positive, F.col(word)) |
                            F.array_contains(negative, F.col(word))))
              .withColumn("_q", qvec))
    sim = _dot(F.col("_u"), F.col("_q")) / _norm(F.col("_q"))
    return (scored.select(word, sim.alias("similarity"))
            .orderBy(F.desc("similarity"), F.col(word)).limit(k))


#: words of a shard of documents, on average
SHARD_PAIRS = 1 << 23
#: fewer, but not less than this, while there are not enough shards for all cores
LEAST_PAIRS = 1 << 18


#: between the words of a text, which hold none
_BREAK = "\0"


def _shard_words(shard: pa.Table) -> pa.Table:
    """The different words of a shard."""
    words = pc.unique(pa.chunked_array(
        [pc.unique(pc.split_pattern(x, _BREAK).flatten())
         for x in shard.column("_words").chunks], pa.string()))
    return pa.table({"_to": pa.array([shard.column("_shard")[0].as_py()]
                                     * len(words), pa.int64()),
                     "_word": words})


def _shard_means(key: str, kind) -> Callable:
    """Means of the documents of one shard, in numpy."""
    def means(texts: pa.Table, vectors: pa.Table) -> pa.Table:
        none = pa.table({key: pa.array([], kind), "mean": pa.array(
            [], pa.list_(pa.float64()))})
        if not len(texts) or not len(vectors):
            return none
        docs = texts.column(key).combine_chunks().dictionary_encode("encode")
        # words without a vector are not counted; a word may have several
        words = vectors.column("_vw").combine_chunks().dictionary_encode()
        at, doc = [], []
        owner = docs.indices.to_numpy(zero_copy_only=False)
        done = 0
        for chunk in texts.column("_words").chunks:
            lists = pc.split_pattern(chunk, _BREAK)
            x = pc.index_in(lists.flatten(), words.dictionary)
            x = pc.fill_null(x, -1).to_numpy()
            n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            at.append(x[x >= 0])
            doc.append(np.repeat(owner[done:done + len(lists)], n)[x >= 0])
            done += len(lists)
        at, doc = np.concatenate(at), np.concatenate(doc)
        if not len(at):
            return none
        own = words.indices.to_numpy()
        copies = np.bincount(own, minlength=len(words.dictionary))
        flat = vectors.column("_v").combine_chunks()
        dim = len(flat[0])
        values = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        if (copies > 1).any():
            sums = np.zeros((len(copies), dim))
            np.add.at(sums, own, values.astype(np.float64))
        else:
            sums = np.empty_like(values)
            sums[own] = values
        if (doc[1:] < doc[:-1]).any():
            order = np.argsort(doc, kind="stable")
            doc, at = doc[order], at[order]
        ids, first = np.unique(doc, return_index=True)
        weight = np.add.reduceat(copies[at], first)
        out = np.empty((len(ids), dim))
        ends = np.append(first[1:], len(doc))
        for i, (lo, hi) in enumerate(zip(first, ends, strict=True)):
            out[i] = sum(sums[at[x:min(x + WORDS_AT_ONCE, hi)]].sum(
                0, dtype=np.float64) for x in range(lo, hi, WORDS_AT_ONCE))
        out /= weight[:, None]
        mean = pa.ListArray.from_arrays(
            np.arange(len(ids) + 1, dtype=np.int32) * dim, out.ravel())
        return pa.table({key: docs.dictionary.take(pa.array(ids)),
                         "mean": mean})
    return means


#: vectors that are added up at once
WORDS_AT_ONCE = 1 << 14


def doc_mean_vectors(tokens: DataFrame, vectors: DataFrame,
                     key: str = "doc_id", word: str = "w",
                     vec: str = "vec", vec_word: str = "word",
                     lists: DataFrame | None = None) -> DataFrame:
    """V3: ``(key, mean ARRAY<DOUBLE>)`` = average vector of the document's
    in-vocabulary tokens.

    ``lists`` (key, words) has the tokens as one array a text, if given.
    Texts are dealt into shards of about ``SHARD_PAIRS`` words; a shard pulls
    the vector of each of its words once.  A text is shuffled once, and neither
    its words nor their counts are rows of a shuffle."""
    if lists is None:
        lists = tokens.groupBy(key).agg(F.collect_list(word).alias("words"))
    lists = lists.select(key, F.array_compact("words").alias("_words")).filter(
        F.size("_words") > 0)
    n = lists.agg(F.sum(F.size("_words"))).first()[0] or 0
    lists = lists.withColumn("_words", F.array_join("_words", _BREAK))
    par = lists.sparkSession.sparkContext.defaultParallelism
    shards = max(1, -(-n // SHARD_PAIRS), min(par, n // LEAST_PAIRS))
    x = lists.withColumn("_shard", F.pmod(F.hash(key), F.lit(shards))
                         .cast("long")).groupBy("_shard")
    v = vectors.filter(F.col(vec).isNotNull()).select(
        F.col(vec_word).alias("_word"), F.col(vec).alias("_v"))
    pulled = x.applyInArrow(_shard_words, "_to long, _word string").join(
        v, "_word").select("_to", F.col("_word").alias("_vw"), "_v")
    kind = lists.schema[key].dataType
    return x.cogroup(pulled.groupBy("_to")).applyInArrow(
        _shard_means(key, to_arrow_type(kind)),
        f"{key} {kind.simpleString()}, mean array<double>")


def doc_concat_vectors(tokens: DataFrame, vectors: DataFrame, n: int = 10,
                       dim: int | None = None, key: str = "doc_id",
                       word: str = "w", pos: str = "pos", vec: str = "vec",
                       vec_word: str = "word",
                       docs: DataFrame | None = None) -> DataFrame:
    """V4: first ``n`` in-vocabulary words, vectors concatenated, zero filled
    to ``n * dim``.  With ``docs`` (a frame of keys) also the documents
    without a known word have a row, all zeros.

    Words are looked up without their vectors: in the first ``HEAD * n``
    positions of every document, and in the rest of those that have fewer than
    ``n`` known words there.  Only the chosen words meet the vectors."""
    v = vectors.select(F.col(vec_word).alias(word), F.col(vec).alias("_v"))
    d = dim or v.agg(F.max(F.size("_v"))).scalar()
    # a word with several vectors counts as often
    v = cut_lineage(v.groupBy(word).agg(F.collect_list(
        F.struct("_v")).alias("_vs")))
    known = v.select(word, F.size("_vs").alias("_copies"))
    head = HEAD * n
    x = tokens.select(key, pos, word)
    found = cut_lineage(_first(x.filter(F.col(pos) < head).join(known, word),
                               n, key, pos))
    full = found.groupBy(key).agg(F.sum("_copies").alias("_c")).filter(
        F.col("_c") >= n).select(key)
    rest = x.filter(F.col(pos) >= head)
    more = cut_lineage(rest.select(key).distinct().join(
        full, key, "left_anti").withColumnRenamed(key, "_key"))
    rest = rest.join(more, rest[key].eqNullSafe(more["_key"]), "left_semi"
                     ).join(known, word)
    r = _first(found.unionByName(rest), n, key, pos)
    c = r.join(v, word).select(key, F.posexplode("_vs").alias("_i", "_s"), pos)
    g = c.groupBy(key).agg(F.slice(F.array_sort(F.collect_list(F.struct(
        F.col(pos).alias("_p"), "_i", F.col("_s._v").alias("_v")))), 1, n)
        .alias("_c")).select(key, F.flatten(F.transform(
            "_c", lambda s: as_double(s["_v"]))).alias("_c"))
    if docs is not None:
        g = docs.select(key).join(g, key, "left").withColumn(
            "_c", F.coalesce("_c", F.array().cast("array<double>")))
    total = F.lit(n) * d
    return g.select(key, F.concat("_c", F.array_repeat(
        F.lit(0.0), (total - F.size("_c")).cast("int"))).alias("concat"))


#: so many times the wanted words are looked up first
HEAD = 4


def _first(hits: DataFrame, n: int, key: str, pos: str) -> DataFrame:
    """The first ``n`` rows of every key by position."""
    from pyspark.sql import Window
    return hits.withColumn("_r", F.row_number().over(
        Window.partitionBy(key).orderBy(pos))).filter(
        F.col("_r") <= n).drop("_r")


def doc_sequence_vectors(tokens: DataFrame, vectors: DataFrame, steps: int = 20,
                         dim: int | None = None, key: str = "doc_id",
                         word: str = "w", pos: str = "pos", vec: str = "vec",
                         vec_word: str = "word", first_pos: int = 0
                         ) -> DataFrame:
    """V5: first ``steps`` positions; unknown words and missing steps are
    zero vectors.  ``(key, step, vec)`` for steps 0..steps-1."""
    v = vectors.select(F.col(vec_word).alias(word), as_double(vec).alias("_v"))
    d = dim or v.agg(F.max(F.size("_v"))).scalar()
    zeros = F.array_repeat(F.lit(0.0), d)
    first = tokens.filter(F.col(pos) < first_pos + steps)
    j = first.join(v, word, "left").select(
        key, (F.col(pos) - first_pos).alias("step"),
        F.coalesce("_v", zeros).alias("vec"))
    docs = tokens.select(key).distinct()
    grid = docs.select(key, F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))
                       .alias("step"))
    return (grid.join(j, [key, "step"], "left")
            .select(key, F.col("step").cast("long").alias("step"),
                    F.coalesce("vec", zeros).alias("vec")))


def embedding_matrix(vocab_ids: DataFrame, vectors: DataFrame,
                     word: str = "word", vec: str = "vec",
                     vec_word: str = "word") -> DataFrame:
    """V6: ``(id, word, vec)``, all rows of the ``(V + 2) x (d + 1)`` matrix.

    A word with a vector of ``lower(word)`` has that vector plus the
    capitalisation code; words without one and the ids 0 (padding) and
    V + 1 (unknown word), whose ``word`` is null, are all zeros."""
    v = vectors.select(F.col(vec_word).alias("_lw"),
                       as_double(vec).alias("_v"))
    d = v.agg(F.max(F.size("_v"))).scalar()
    zeros = F.array_repeat(F.lit(0.0), (d + 1).cast("int"))
    j = vocab_ids.select("id", word).withColumn("_lw", F.lower(word)).join(
        v, "_lw", "left")
    rows = j.select("id", word, F.when(F.col("_v").isNotNull(), F.concat(
        "_v", F.array(cap_code(F.col(word)).cast("double"))))
        .otherwise(zeros).alias("vec"))
    size = vocab_ids.agg(F.count(F.lit(1))).select(F.explode(F.array(
        F.lit(0).cast("long"), F.col("count(1)") + 1)).alias("id"))
    extra = size.select("id", F.lit(None).cast("string").alias(word),
                        zeros.alias("vec"))
    return rows.unionByName(extra)


def explode_vector(df: DataFrame, keys: Sequence[str], vec: str,
                   dim: str = "dim", value: str = "value") -> DataFrame:
    """Long form ``(keys..., dim, value)`` of an array column."""
    return df.select(*keys, F.posexplode(vec).alias(dim, value)).withColumn(
        dim, F.col(dim).cast("long"))
