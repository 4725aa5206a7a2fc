"""Scans and sinks.

Token files (one token per line, blank line between sentences) are read with
``lineSep="\\n\\n"`` so that each record is a whole sentence: sentence
boundaries never need a sequential pass over the file, and splits of a large
file are read in parallel.  Sinks write one record per sentence the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.plans.lineage import scratch_path as scratch_path
from textflow.plans.ranking import global_row_number

_BLANKS = " \t\r\n"


def _strip(c) -> F.Column:
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(_BLANKS))


def scan_token_file(spark: SparkSession, path: str, sep: str = "\t",
                    with_label: bool = True, line_sep: str | None = None
                    ) -> DataFrame:
    """``(sent_id, pos, word[, tag])`` from a token file.

    Lines are ``index<sep>word[<sep>tag]``; fields are stripped of all white
    space; a line that is only white space ends a sentence like an empty one.
    ``sent_id`` is the 1-based sentence number in file order.  The record
    separator is a blank line in the line ends of the file (``\\r\\n`` files
    are recognised by their first line) unless given.
    """
    if line_sep is None:
        first = spark.read.option("lineSep", "\n").text(path).limit(1)
        crlf = not first.filter(F.col("value").endswith("\r")).isEmpty()
        line_sep = "\r\n\r\n" if crlf else "\n\n"
    raw = spark.read.option("lineSep", line_sep).text(path)
    # file order = (file, split offset, position inside the split): the scan
    # packs files into partitions by size, so partition order alone is not
    # file order.  A whitespace-only line inside a record also separates
    # sentences.
    recs = raw.select(F.col("_metadata.file_path").alias("_f"),
                      F.col("_metadata.file_block_start").alias("_o"),
                      F.monotonically_increasing_id().alias("_rid"),
                      F.posexplode(F.split("value", "\\n[ \\t\\r]*\\n"))
                      .alias("_j", "_s"))
    recs = recs.filter(F.length(_strip("_s")) > 0)
    recs = global_row_number(recs, ["_f", "_o", "_rid", "_j"], "sent_id")
    lines = recs.select("sent_id", F.posexplode(F.split("_s", "\\n"))
                        .alias("_k", "_l")).filter(F.length(_strip("_l")) > 0)
    f = F.split(_strip("_l"), sep)
    cols = [F.col("sent_id"), (F.col("_k") + 1).cast("long").alias("pos"),
            _strip(F.get(f, 0)).cast("long").alias("idx"),
            _strip(F.get(f, 1)).alias("word")]
    if with_label:
        cols.append(_strip(F.get(f, 2)).alias("tag"))
    return lines.select(*cols)


def sentence_blocks(tokens: DataFrame, fields: list[str], sep: str = "\t",
                    key: str = "sent_id", pos: str = "pos") -> DataFrame:
    """One text block per sentence, lines in position order."""
    line = F.concat_ws(sep, *[F.col(c).cast("string") for c in fields])
    return tokens.groupBy(key).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(F.col(pos), line.alias("l")))),
        lambda s: s["l"]), "\n").alias("block"))


def write_token_file(blocks: DataFrame, path: str, key: str = "sent_id"
                     ) -> None:
    """Write sentence blocks in key order, a blank line between sentences."""
    (blocks.orderBy(key).select("block").write.mode("overwrite")
     .option("lineSep", "\n\n").text(path))


def write_vectors_text(vectors: DataFrame, path: str, word: str = "word",
                       vec: str = "vec") -> None:
    """Vector table as gzip text ``word v1 ... vd``."""
    line = F.concat_ws(" ", F.col(word), F.array_join(
        F.col(vec).cast("array<string>"), " "))
    (vectors.select(line.alias("value")).write.mode("overwrite")
     .option("compression", "gzip").text(path))


def scan_vectors_text(spark: SparkSession, path: str,
                      partitions: int | None = None) -> DataFrame:
    """``(word, vec ARRAY<FLOAT>)`` from whitespace-separated text
    (gzip allowed; gzip does not split, so the rows are spread after)."""
    t = spark.read.text(path)
    if partitions:
        t = t.repartition(partitions)
    parts = F.split(F.trim("value"), "\\s+")
    return t.select(F.get(parts, 0).alias("word"), F.transform(
        F.slice(parts, 2, F.size(parts) - 1),
        lambda x: x.cast("float")).alias("vec"))


def write_parquet(df: DataFrame, path: str) -> None:
    """Stage cache / model tables."""
    df.write.mode("overwrite").parquet(path)


def write_vocab(vocab: DataFrame, path: str) -> None:
    """``word<TAB>index<TAB>count`` lines in index order (``<unk>`` is
    index 0, so it comes first); range-partitioned sort, parts in order."""
    (vocab.orderBy("id")
     .select(F.concat_ws("\t", "word", F.col("id").cast("string"),
                         F.col("cnt").cast("string")).alias("value"))
     .write.mode("overwrite").text(path))
