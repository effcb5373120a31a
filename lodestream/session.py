"""Session defaults and the folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution re-plans joins and splits skewed partitions at run time;
# the byte sizes keep a task's input well inside executor memory.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Adaptive execution only merges partitions, so a shuffle starts with many.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4096",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(name: str = "lodestream", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Only a session that names none (local tests) gets a temporary folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="lodestream-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local



def stored(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the shared folder: for results with several consumers."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
