"""Stage tables in the shared checkpoint folder and small Arrow helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textflow.plans.lineage import scratch_path


def written(df: DataFrame, name: str, partition_by: str | None = None
            ) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back.

    A committed table survives the loss of any executor and cuts the lineage
    of what is built on it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str,
              name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
