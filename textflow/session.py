"""Session defaults and the shared checkpoint folder.

Every operator is DataFrame-in / DataFrame-out, so the library never needs
a session of its own; this module only gives tests, the bench and scripts
one place to build a local session with the settings the operators assume
(UTC, AQE with skew-join splitting, Arrow), and one place to find the
checkpoint folder used to cut lineage.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE pick a shuffled hash join (no sort of either side) when every
    # post-shuffle partition of the build side is below this size
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "textflow",
              shuffle_partitions: int | None = None,
              driver_memory: str = "16g") -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    master = master or os.environ.get("TEXTFLOW_MASTER", "local[*]")
    b = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; it is read from the session.  Only a local
    master (tests, bench) gets a fresh folder of its own under the system
    temp dir, because there the driver and executors share one machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="textflow-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at shared storage "
        "(HDFS/S3/ABFS) before running operators that cut lineage")
