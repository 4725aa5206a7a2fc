"""Entity tokens: one pass over whole texts, the same labels as by position."""

from pyspark.sql import functions as F

from textflow.sources import fixtures as fx

TEXTS = ["", "Ab cd EF. GhijkÉL m", "x", "AßBc Defg h-I", " Zz ", None,
         "One two\nThree Four five", "中文 Q", "alpha BETA", "Gamma"]


def _documents(spark, tmp_path, ids):
    rows = [(i, t) for i, t in zip(ids, TEXTS, strict=True)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(
        1).write.parquet(f"{tmp_path}/documents.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet").select(
        F.col("doc_id").alias("sent_id"), "text")


def _key(r):
    return [(x is not None, x) for x in r]


def _rows(df):
    return sorted(map(tuple, df.drop("pred").collect()), key=_key)


def test_labels_equal_those_by_position(spark, tmp_path):
    d = _documents(spark, tmp_path, range(10))
    want = _rows(fx.label_runs(d))
    assert len(want) > 15
    assert _rows(fx.entity_tokens(spark, str(tmp_path))) == want


def test_repeated_and_null_ids_are_one_sentence(spark, tmp_path):
    text = "Ab cd EF Ghijk m"
    spark.createDataFrame(
        [(3, text), (3, text), (None, text), (4, text), (5, None)],
        "doc_id long, text string").write.parquet(
            f"{tmp_path}/documents.parquet")
    d = spark.read.parquet(f"{tmp_path}/documents.parquet").select(
        F.col("doc_id").alias("sent_id"), "text")
    got = _rows(fx.entity_tokens(spark, str(tmp_path)))
    assert got == _rows(fx.label_runs(d)) and len(got) == 20


def test_no_shuffle_of_tokens(spark, tmp_path):
    _documents(spark, tmp_path, range(10))
    plan = fx.entity_tokens(spark, str(tmp_path))._jdf.queryExecution(
        ).executedPlan().toString()
    assert "hashpartitioning" not in plan and "Join" not in plan
