"""Session helpers: settings for local runs and durable intermediate tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster supplies its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("colloquy")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        # Small shuffles may keep every core busy instead of ending up in one task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session, taken from ``spark.checkpoint.dir``.

    Only a local run may fall back to a temporary folder: on a cluster a machine-local
    folder would not be there when another executor takes over.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="colloquy-checkpoint-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the checkpoint folder.

    For small derived tables (per-stratum counts, bucket sizes) that several later steps
    read; it survives the loss of executors.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
