"""The spelling step grows with the vocabulary and shuffles no token."""

import random
from string import ascii_lowercase

from pyspark.sql import functions as F

from textflow import queries
from textflow.operators import spell

SMALL = "/root/testdata/sf0.001"


def _pairs(df, keys):
    k = df.select("w", F.explode(keys).alias("k"))
    return k.alias("a").join(k.select(F.col("w").alias("v"), "k"), "k").filter(
        "w < v").select("w", "v").distinct()


def test_words_that_begin_alike_are_no_candidates(spark):
    rnd = random.Random(5)
    words = sorted({"another" + "".join(rnd.choice(ascii_lowercase)
                                        for _ in range(8))
                    for _ in range(150)})
    df = spark.createDataFrame([(w,) for w in words], "w string")
    n = len(words)
    assert _pairs(df, spell.prefix_keys(F.col("w"))).count() == n * (n - 1) / 2
    assert _pairs(df, spell.hashed_keys(F.col("w"))).count() < n


def test_hashed_keys_find_every_close_pair(spark):
    rnd = random.Random(6)
    words = set()
    for _ in range(60):
        w = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 18)))
        words.add(w)
        for _ in range(3):
            i = rnd.randrange(len(w) + 1)
            w = rnd.choice([w[:i] + w[i + 1:], w[:i] + "e" + w[i:],
                            w[:i] + "f" + w[i + 1:]])
            words.add(w)
    df = spark.createDataFrame([(w,) for w in sorted(words) if w], "w string")
    k = df.select("w", spell.hashed_keys(F.col("w")).alias("k"))
    close = df.alias("a").join(df.select(F.col("w").alias("v")), F.levenshtein(
        F.col("w"), F.col("v"), 2) >= 0)
    keys = {r.w: set(r.k) for r in k.collect()}
    assert all(keys[r.w] & keys[r.v] for r in close.collect())
    long_word = spark.createDataFrame([("q" * 1000 + "z" * 1000,)], "w string")
    assert len(long_word.select(spell.hashed_keys(F.col("w"))).first()[0]
               ) <= 79


def test_neighbours_are_read_off_the_texts(spark):
    plan = queries.q_spell_merge(spark, SMALL)._jdf.queryExecution()
    assert "Window" not in plan.executedPlan().toString()
    plan = queries.q_spell_split(spark, SMALL)._jdf.queryExecution()
    assert "Window" not in plan.executedPlan().toString()


def test_adjacent_with_repeated_and_null_keys(spark):
    rows = [(1, "en", ["a", "b", "c"]), (2, "en", []), (3, "de", ["x"]),
            (4, "en", None), (5, None, ["u", "v"]), (6, "en", ["p", "q"]),
            (6, "en", ["p", "q"]), (None, "de", ["m", "n", "m"])]
    lists = spark.createDataFrame(
        rows, "doc_id long, lang string, words array<string>")
    tokens = lists.select("doc_id", "lang", F.posexplode("words").alias(
        "pos", "w")).withColumn("pos", F.col("pos").cast("long"))
    args = (tokens, "w", "doc_id", "pos", ["lang"])
    want = spell.adjacent(*args, None)
    got = spell.adjacent(*args, lists)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        map(tuple, want.collect()), key=repr)
    assert got.count() == 8


def test_merges_and_cuts_by_texts_equal_those_by_positions(spark):
    rows = [(i, "en", "the house is on a lot the hill".split())
            for i in range(30)]
    rows += [(30, "en", "hou se alot the th e".split()),
             (31, "de", "hou se".split()), (31, "en", "hou se".split()),
             (None, "en", "hou se".split())]
    lists = spark.createDataFrame(
        rows, "doc_id long, lang string, words array<string>")
    tokens = lists.select("doc_id", "lang", F.posexplode("words").alias(
        "pos", "w")).withColumn("pos", F.col("pos").cast("long"))
    for call in (spell.spell_merges, spell.spell_splits):
        got, want = (sorted(map(tuple, call(tokens, group=["lang"], lists=x)
                                .collect()), key=repr) for x in (lists, None))
        assert got == want and got


def test_pipelines_shuffle_texts_before_their_tokens(spark):
    for query in (queries.q_clean_pipeline_lemmas,
                  queries.q_clean_pipeline_vectors):
        plan = query(spark, SMALL)._jdf.queryExecution().executedPlan()
        shuffles = [x for x in plan.toString().splitlines()
                    if "Exchange hashpartitioning" in x]
        assert len(shuffles) == 1 and "REPARTITION" in shuffles[0]
