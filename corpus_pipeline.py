"""A corpus pipeline: language ID, exact dedup, near-dedup, decontamination,
byte-level BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of the documents.  :func:`run` writes each stage as
Parquet into the shared checkpoint folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.llm.bpe import encode_decode
from textflow.llm.decontaminate import remove_contaminated
from textflow.llm.exact_dedup import drop_copies
from textflow.llm.lang_id import UNKNOWN, predict, train
from textflow.llm.near_dedup import drop_near_copies
from textflow.llm.stage import documents, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str
                ) -> DataFrame:
    """Documents in a learned language; null texts and texts without a
    letter go."""
    labelled = predict(docs, train(docs), segments=False)
    return labelled.filter(F.col("lang_pred") != UNKNOWN).select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str
                ) -> DataFrame:
    """One document of each group of equal texts (the largest doc_id)."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str
               ) -> DataFrame:
    """One document of each group of near-duplicates (the largest doc_id)."""
    return drop_near_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str
                  ) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    return remove_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the decoded text."""
    import public_tokenizers

    return encode_decode(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        ["n_tokens", "ids", "decoded_sha256"]
    ).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("byte_bpe", byte_bpe),
]

#: SQL can express neither the field, the signatures nor the merges
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
