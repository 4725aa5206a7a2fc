"""Lineage cuts and the stage tables they leave behind."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textflow.session import ensure_checkpoint_dir

#: folders written by this process and not yet removed
_WRITTEN: list[str] = []
#: called with every frame that is about to be written (plan checks)
OBSERVERS: list[Callable[[DataFrame], None]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and
    read it back.

    Used where a plan would otherwise grow with every iteration (training
    epochs), where a non-deterministic expression (partition-position ids)
    must be frozen before it is read twice, or where a costly intermediate
    is read several times.  The table lives in the shared
    ``spark.checkpoint.dir``, so it survives the loss of any executor, and
    parquet is several times faster to write and read than an RDD
    checkpoint of the same rows.  :func:`drop_stage_tables` removes it.
    """
    spark = df.sparkSession
    for observe in OBSERVERS:
        observe(df)
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage_tables(spark: SparkSession) -> int:
    """Remove every stage table and scratch file this process has written.

    Call it when the results built on them have been written: the frames
    that queries return read these tables lazily.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    n = 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
