"""A language whose labelled texts are all long is learned as well."""

import random

from textflow.llm.lang_id import SAMPLE_BYTES, predict, train

WORDS = {"aa": ["kala", "mato", "talo", "vene", "saari"],
         "bb": ["ştíř", "hřích", "čtvrt", "žlutý", "kůň"]}


def _text(rnd, lang, n):
    return ". ".join(" ".join(rnd.choice(WORDS[lang]) for _ in range(8))
                     for _ in range(n))


def test_long_texts_are_learned(spark):
    rnd = random.Random(5)
    rows = [(i, _text(rnd, "aa", 5), "aa") for i in range(40)]
    rows += [(100 + i, "12 " * 9000 + _text(rnd, "bb", 600), "bb")
             for i in range(20)]
    assert all(len(t.encode()) > SAMPLE_BYTES for i, t, _ in rows if i >= 100)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train(df)
    assert sorted(model.langs) == ["aa", "bb"]
    for some in (df, df.filter("lang = 'bb'")):
        got = predict(some, train(some), segments=False).collect()
        assert all(r.lang_pred == r.row.lang for r in got)
