"""Structured Streaming form of the text cleaning and counting operators.

The reference reads closed files only, but its cleaning stages are
per-row projections, so the same Column expressions run unchanged on a
streaming DataFrame; word counts become a stateful streaming aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.functions.text import clean_text, word_array


def read_documents_stream(spark: SparkSession, directory: str,
                          file_glob: str = "*.parquet",
                          max_files_per_trigger: int = 1) -> DataFrame:
    """Parquet files matching ``file_glob`` arriving in ``directory``
    (schema taken from the files already there)."""
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(
        directory).schema
    return (spark.readStream.schema(schema)
            .option("pathGlobFilter", file_glob)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(directory))


def clean_stream(docs: DataFrame, text: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """T1-T5 on a stream: ``(key, body)``; stateless, append mode."""
    return docs.select(key, clean_text(text).alias("body"))


def word_count_stream(cleaned: DataFrame, body: str = "body",
                      min_len: int = 2) -> DataFrame:
    """K1 on a stream: running ``(word, cnt)``; use ``update`` or
    ``complete`` output mode (state is one row per distinct word)."""
    return (cleaned.select(F.explode(word_array(body, min_len)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))


def run_to_memory(df: DataFrame, name: str, mode: str,
                  checkpoint: str) -> None:
    """Drive a streaming query to completion into a memory table (tests,
    notebooks); production sinks use ``foreachBatch`` or a table sink."""
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
