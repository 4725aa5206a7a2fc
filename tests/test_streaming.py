from pyspark.sql import functions as F

from textflow.sources import fixtures as fx
from textflow.streaming import clean_stream as cs
from textflow.session import ensure_checkpoint_dir

SMALL = "/root/testdata/sf0.001"


def test_stream_clean_and_counts_equal_batch(spark):
    base = ensure_checkpoint_dir(spark)
    stream = cs.read_documents_stream(spark, SMALL, "documents.parquet")
    cleaned = cs.clean_stream(stream)
    cs.run_to_memory(cleaned, "clean_out", "append", f"{base}/s1")
    cs.run_to_memory(cs.word_count_stream(cleaned), "wc_out", "complete",
                     f"{base}/s2")
    got = {r.doc_id: r.body for r in spark.table("clean_out").collect()}
    want = {r.doc_id: r.body for r in fx.clean_docs(spark, SMALL).collect()}
    assert got == want
    wc = {r.word: r.cnt for r in spark.table("wc_out").collect()}
    batch = (fx.clean_docs(spark, SMALL)
             .select(F.explode(F.filter(F.split("body", " "),
                                        lambda x: F.length(x) >= 2))
                     .alias("word"))
             .groupBy("word").count())
    assert wc == {r.word: r["count"] for r in batch.collect()}
