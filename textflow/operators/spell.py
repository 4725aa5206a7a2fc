"""Spelling correction as vocabulary-level Spark jobs.

The reference corrects each review with an in-memory symmetric-delete index.
Here every distinct word (not every token) expands to the delete keys of its
first twelve letters (all strings left after removing up to two characters, as
hashes), and rare words meet dictionary words on equal keys.  The keys are some
sixty times the words, so they are neither shuffled nor broadcast: blocks of
words meet blocks of the dictionary, each pair of blocks makes and compares its
keys in one task, and candidates are verified on the whole words.  Two words within
edit distance 2 always share a key of their prefixes, whatever their length,
so no pair is lost, and a word of any length has at most 79 keys.  (Words of
one corpus begin alike: with seven letters the candidates grow almost with the
square of the vocabulary.)  The corpus supplies the dictionary (words with
count >= ``min_count``), optionally per language.

The dictionary is a stage table of its own: while it is small, Spark sends it
to the tokens, and no token is shuffled to look it up.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.functions.constants import CONTRACTIONS
from textflow.operators.edits import block_matches
from textflow.plans.lineage import cut_lineage
from textflow.plans.sequence import neighbors


def _drop_each(s: Column) -> Column:
    """All strings obtained by removing exactly one character of ``s``."""
    return F.when(F.length(s) > 0, F.transform(
        F.sequence(F.lit(1), F.length(s)),
        lambda i: F.concat(F.substr(s, F.lit(1), i - 1),
                           F.substr(s, i + 1, F.length(s))))).otherwise(
        F.array().cast("array<string>"))


def delete_keys(w: Column, max_deletes: int = 2) -> Column:
    """The word itself and every string left after up to ``max_deletes``
    character deletions (distinct)."""
    level = F.array(w)
    keys = level
    for _ in range(max_deletes):
        level = F.array_distinct(F.flatten(F.transform(level, _drop_each)))
        keys = F.concat(keys, level)
    return F.array_distinct(keys)


KEY_PREFIX = 7
LONG_PREFIX = 12        # of the corrections
#: words of a block, on average: a task makes the keys of one of each
DICTIONARY_BLOCK, WORD_BLOCK = 1 << 15, 1 << 16


def prefix_keys(w: Column, max_deletes: int = 2, prefix: int = KEY_PREFIX
                ) -> Column:
    return delete_keys(F.substring(w, 1, prefix), max_deletes)


def hashed_keys(w: Column, max_deletes: int = 2) -> Column:
    return F.transform(prefix_keys(w, max_deletes, LONG_PREFIX),
                       lambda k: F.xxhash64(k))


def word_counts(tokens: DataFrame, word: str = "w",
                group: Sequence[str] = ()) -> DataFrame:
    return tokens.groupBy(*group, F.col(word).alias("word")).agg(
        F.count(F.lit(1)).alias("cnt"))


def vocabulary(tokens: DataFrame, word: str = "w",
               group: Sequence[str] = (), min_count: int = 20
               ) -> tuple[DataFrame, DataFrame]:
    """``(group..., word, cnt)`` of the dictionary and of the rare words, as
    two stage tables from one count."""
    wc = cut_lineage(word_counts(tokens, word, group))
    return (cut_lineage(wc.filter(F.col("cnt") >= min_count)),
            wc.filter(F.col("cnt") < min_count))


def adjacent(tokens: DataFrame, word: str, key: str, pos: str,
             group: Sequence[str], lists: DataFrame | None) -> DataFrame:
    """``(key, pos, group..., word, <word>_p1)`` of every word with a word
    after it.

    ``lists`` (key, group..., words) has the tokens as one array a text, if
    given: neighbours are read off it and nothing is shuffled.  Only texts
    whose key repeats or is null are one sequence together, by positions.
    """
    g = list(group)
    after = f"{word}_p1"

    def by_position(t: DataFrame) -> DataFrame:
        n = neighbors(t.select(key, pos, word, *g), key, pos, [word], [1],
                      keep=g)
        return n.filter(F.col(after).isNotNull()).select(key, pos, *g, word,
                                                         after)

    if lists is None:
        return by_position(tokens)
    shared = lists.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(
        (F.col("n") > 1) | F.col(key).isNull()).select(F.col(key).alias("_id"))
    some = not shared.isEmpty()
    same = F.col(key).eqNullSafe(F.col("_id"))
    own = lists.join(shared, same, "left_anti") if some else lists
    own = own.select(key, *g, F.col("words").alias(word), F.slice(
        "words", F.lit(2), F.greatest(F.size("words"), F.lit(0)))
        .alias(after))
    n = own.select(key, *g, F.posexplode(F.arrays_zip(word, after)).alias(
        pos, "_x")).select(key, F.col(pos).cast("long").alias(pos), *g,
                           f"_x.{word}", f"_x.{after}")
    n = n.filter(F.col(after).isNotNull())
    return n.union(by_position(tokens.join(shared, same, "left_semi"))) \
        if some else n


def spell_corrections(tokens: DataFrame, word: str = "w",
                      group: Sequence[str] = (), min_count: int = 20,
                      max_distance: int = 2,
                      known: tuple[DataFrame, DataFrame] | None = None
                      ) -> DataFrame:
    """``(group..., word, correction, distance)`` for every word below
    ``min_count`` that has a dictionary word within ``max_distance``.

    Best = smallest distance, then most frequent, then alphabetical.  Words
    and dictionary meet by blocks of a group (:mod:`textflow.operators.edits`):
    what is shuffled are the words, once for a block of the other side, never
    their keys.
    ``known`` is the :func:`vocabulary`, if the caller has it.
    """
    g = list(group)
    dic, probe = known or vocabulary(tokens, word, g, min_count)
    dic, probe = (x.filter(F.col("word").isNotNull()) for x in (dic, probe))

    def blocks(words: DataFrame, name: str, size: int) -> DataFrame:
        return words.groupBy(*g).agg(F.ceil(F.count(F.lit(1)) / size)
                                     .cast("long").alias(name))

    # every block of words meets every block of its group's dictionary
    sizes = blocks(dic, "_nd", DICTIONARY_BLOCK)
    of = blocks(probe, "_np", WORD_BLOCK)
    sizes = cut_lineage((sizes.join(of, g) if g else sizes.crossJoin(of))
                        .filter("_nd > 0 and _np > 0"))

    def dealt(words: DataFrame, own: str, other: str) -> DataFrame:
        x = words.join(sizes, g) if g else words.crossJoin(sizes)
        return x.withColumn("_b" + own, F.pmod(F.xxhash64("word"),
                                               F.col("_n" + own))).withColumn(
            "_b" + other, F.explode(F.sequence(
                F.lit(0).cast("long"), F.col("_n" + other) - 1)))

    keys = [*g, "_bp", "_bd"]
    left = dealt(probe, "p", "d").select(*keys, "word").groupBy(*keys)
    right = dealt(dic, "d", "p").select(
        *[F.col(c).alias(f"_of_{c}") for c in keys],
        F.col("word").alias("_cand"), F.col("cnt").alias("_cc")).groupBy(
            *[f"_of_{c}" for c in keys])
    pairs = left.cogroup(right).applyInArrow(
        block_matches(max_distance, g), T.StructType([
            *[probe.schema[c] for c in g],
            T.StructField("word", T.StringType()),
            T.StructField("cand", T.StringType()),
            T.StructField("cc", T.LongType()),
            T.StructField("dist", T.IntegerType())]))
    best = pairs.groupBy(*g, "word").agg(F.min_by(
        F.struct("cand", "dist"),
        F.struct("dist", -F.col("cc"), "cand")).alias("b"))
    return best.select(*g, "word", F.col("b.cand").alias("correction"),
                       F.col("b.dist").cast("long").alias("distance"))


def spell_merges(tokens: DataFrame, word: str = "w", key: str = "doc_id",
                 pos: str = "pos", group: Sequence[str] = (),
                 min_count: int = 20, lists: DataFrame | None = None
                 ) -> DataFrame:
    """Adjacent pairs whose concatenation is a dictionary word while at
    least one part is not: ``(key, pos, w, next_w, merged)``; ``lists`` as in
    :func:`adjacent`."""
    g = list(group)
    dic, _ = vocabulary(tokens, word, g, min_count)
    n = adjacent(tokens, word, key, pos, g, lists).withColumn(
        "merged", F.concat(word, f"{word}_p1"))
    d = dic.select(*g, F.col("word").alias("_d"))
    known_l = d.select(*g, F.col("_d").alias(word))
    known_r = d.select(*g, F.col("_d").alias(f"{word}_p1"))
    n = (n.join(d.withColumnRenamed("_d", "merged"), [*g, "merged"],
                "left_semi")
         .join(known_l.withColumn("_kl", F.lit(1)), [*g, word], "left")
         .join(known_r.withColumn("_kr", F.lit(1)), [*g, f"{word}_p1"],
               "left")
         .filter(F.col("_kl").isNull() | F.col("_kr").isNull()))
    return n.select(key, pos, *g, word, F.col(f"{word}_p1").alias("next_w"),
                    "merged")


def spell_splits(tokens: DataFrame, word: str = "w", key: str = "doc_id",
                 pos: str = "pos", group: Sequence[str] = (),
                 min_count: int = 20, with_count: bool = False,
                 lists: DataFrame | None = None,
                 known: tuple[DataFrame, DataFrame] | None = None
                 ) -> DataFrame:
    """A non-dictionary word cut into two dictionary words; best cut by
    corpus bigram count, then unigram count product, then earliest cut:
    ``(group..., word, left, right)``, and the bigram count ``bc`` if asked
    for.  Bigrams are counted by a 64-bit hash; ``lists`` as in
    :func:`adjacent`, ``known`` as in :func:`spell_corrections`."""
    g = list(group)
    dic, probe = known or vocabulary(tokens, word, g, min_count)
    probe = probe.filter(F.length("word") >= 2)
    cuts = probe.select(*g, "word", F.explode(F.sequence(
        F.lit(1), F.length("word") - 1)).alias("i"))
    cuts = cuts.select(*g, "word", "i",
                       F.substr("word", F.lit(1), F.col("i")).alias("left"),
                       F.substr("word", F.col("i") + 1, F.length("word"))
                       .alias("right"))
    dl = dic.select(*g, F.col("word").alias("left"), F.col("cnt").alias("cl"))
    dr = dic.select(*g, F.col("word").alias("right"), F.col("cnt").alias("cr"))
    c = cuts.join(dl, [*g, "left"]).join(dr, [*g, "right"])
    bigrams = (adjacent(tokens, word, key, pos, g, lists)
               .groupBy(F.xxhash64(*g, word, f"{word}_p1").alias("h"))
               .agg(F.count(F.lit(1)).alias("bc")))
    c = c.withColumn("h", F.xxhash64(*g, "left", "right")).join(
        bigrams, "h", "left").withColumn("bc", F.coalesce("bc", F.lit(0)))
    best = c.groupBy(*g, "word").agg(F.min_by(
        F.struct("left", "right", "bc"),
        F.struct(-F.col("bc"), -(F.col("cl") * F.col("cr")), F.col("i")))
        .alias("b"))
    return best.select(*g, "word", F.col("b.left").alias("left"),
                       F.col("b.right").alias("right"),
                       *([F.col("b.bc").alias("bc")] if with_count else []))


# a contraction is one word, which T6 rewrites later; else runs of letters
LETTER_RUN = re.compile("[A-Za-z]+")
TEXT_WORD = re.compile(r"(?i)\b(?:" + "|".join(c for c, _ in CONTRACTIONS)
                       + r")\b|[a-z]+", re.ASCII)


def _pattern(text: str) -> re.Pattern:
    return TEXT_WORD if "'" in text else LETTER_RUN


def word_changes(tokens: DataFrame, key: str = "doc_id",
                 group: Sequence[str] = (), min_count: int = 20,
                 lists: DataFrame | None = None,
                 known: tuple[DataFrame, DataFrame] | None = None
                 ) -> DataFrame:
    """``(group..., word, new)``: the correction (T7) or the two parts (T9) of
    every word that has one.  A cut costs one edit; against a correction of
    one edit it wins if the corpus has the two words side by side."""
    g = list(group)
    known = known or vocabulary(tokens, "w", g, min_count)
    fixes = spell_corrections(tokens, "w", g, min_count, known=known)
    cuts = spell_splits(tokens, "w", key, "pos", g, min_count,
                        with_count=True, lists=lists, known=known)
    cut_wins = F.col("left").isNotNull() & (
        F.col("distance").isNull() | (F.col("distance") > 1)
        | (F.col("bc") > 0))
    return fixes.join(cuts, [*g, "word"], "full").select(
        *g, "word", F.when(cut_wins, F.concat("left", F.lit(" "), "right"))
        .otherwise(F.col("correction")).alias("new"))


def _rows(batches: Iterator[pa.RecordBatch], make: Callable[..., Iterator],
          like: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows that ``make`` yields for every input row, in bounded batches."""
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        cols = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(cols, like, strict=True)],
            schema=like)

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            for made in make(*row):
                out.append(made)
                if len(out) >= OUT_ROWS:
                    yield batch()
                    out.clear()
    if out:
        yield batch()


OUT_ROWS = 4096


def _map_rows(df: DataFrame, make: Callable[..., Iterator],
              schema: T.StructType) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    like = to_arrow_schema(schema)
    return df.mapInArrow(lambda it: _rows(it, make, like), schema)


def _words_of(text: str, *ids) -> Iterator[tuple]:
    for w in dict.fromkeys(map(str.lower, _pattern(text).findall(text))):
        yield *ids, w


def _pairs_of(text: str, odd: list[dict] | None, *ids) -> Iterator[tuple]:
    """Neighbours written as one word, where a part is not in the
    dictionary."""
    unknown = {x["w"] for x in odd or ()}
    if unknown:
        low = [w.lower() for w in _pattern(text).findall(text)]
        for m in dict.fromkeys(a + b for a, b in pairwise(low)
                               if a in unknown or b in unknown):
            yield *ids, m


def recased(raw: str, new: str) -> str:
    """``new`` in capitals or with a first capital, if ``raw`` is so."""
    if len(raw) > 1 and raw.isupper():
        return new.upper()
    return new[:1].upper() + new[1:] if raw[:1].isupper() else new


def _rewritten(text: str, odd: list[dict] | None, merged: list[str] | None,
               *ids) -> Iterator[tuple]:
    """One pass over the words, from left to right."""
    change = {x["w"]: x["new"] for x in odd or ()}
    whole = set(merged or ())
    out, done, taken = [], 0, False
    words = list(_pattern(text).finditer(text)) if change else []
    low = [m[0].lower() for m in words]
    for i, m in enumerate(words):
        if taken:                       # went into the word before
            taken = False
            continue
        new, raw, end = change.get(low[i]), m[0], m.end()
        if whole and i + 1 < len(words):
            both = low[i] + low[i + 1]
            if both in whole and (low[i] in change or low[i + 1] in change):
                new, raw, end = both, raw + words[i + 1][0], words[i + 1].end()
                taken = True
        if new is not None:
            out += [text[done:m.start()], recased(raw, new)]
            done = end
    yield *ids, "".join(out) + text[done:] if out else text


def correct_texts(docs: DataFrame, tokens: DataFrame, text: str = "text",
                  key: str = "doc_id", group: Sequence[str] = (),
                  min_count: int = 20, lists: DataFrame | None = None
                  ) -> DataFrame:
    """``(key, text)``: T7-T9 applied to whole texts.  The words of a text
    are its runs of letters, looked up in lower case; casing and what stands
    between the words stay.

    A merge (T8) replaces two words and what is between them, from left to
    right; words that are not merged are corrected or cut (``word_changes``).
    A text's distinct words meet the vocabulary; those that the dictionary
    lacks come back to it, and the text is rewritten in one pass.
    """
    g = list(group)
    ids = [docs.schema[c] for c in (key, *g)]
    word = T.StructField("w", T.StringType())
    docs = docs.filter(F.col(text).isNotNull()).select(
        F.col(text).alias("text"), key, *g)
    known = vocabulary(tokens, "w", g, min_count)
    dic = known[0].select(*g, F.col("word").alias("w"))
    change = word_changes(tokens, key, g, min_count, lists,
                          known).withColumnRenamed("word", "w")
    odd = (_map_rows(docs, _words_of, T.StructType([*ids, word]))
           .join(dic, [*g, "w"], "left_anti").join(change, [*g, "w"], "left")
           .groupBy(key, *g).agg(F.collect_list(F.struct("w", "new"))
                                 .alias("odd")))
    docs = cut_lineage(docs.join(odd, [key, *g], "left").select(
        "text", "odd", key, *g))
    # merges are rare: a small stage table goes to the texts
    merged = cut_lineage(
        _map_rows(docs, _pairs_of, T.StructType([*ids, word]))
        .join(dic, [*g, "w"], "left_semi").groupBy(key, *g)
        .agg(F.collect_list("w").alias("merged")))
    docs = docs.join(merged, [key, *g], "left").select("text", "odd",
                                                       "merged", key)
    return _map_rows(docs, _rewritten, T.StructType(
        [ids[0], T.StructField("text", T.StringType())]))
