"""Log streams: error tail, labelled storage, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestream.operators import logs
from lodestream.streaming.telemetry import LATE_LIMIT

_PARTITIONS = ("day", "job", "endpoint", "level", "batch")


def error_stream(entries: DataFrame, text: str = "ERROR") -> DataFrame:
    return logs.errors(entries, text)


def store_logs(entries: DataFrame, path: str, checkpoint: str, *, every: str | None = "60 seconds") -> StreamingQuery:
    """Append entries under job / endpoint / level folders, once a minute.

    ``every=None`` takes what is there and stops.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = entries.writeStream.outputMode("append").format("parquet").partitionBy("job", "endpoint", "level")
    return writer.option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def keep_logs(entries: DataFrame, path: str, checkpoint: str, *, limit: str = LATE_LIMIT, every: str | None = "60 seconds") -> StreamingQuery:
    """Like ``store_logs``, under day / job / endpoint / level / batch folders that expire.

    A micro-batch that is run again replaces its own folders, so every entry is stored
    once. After each micro-batch, days that ended more than ``limit`` before the newest entry of
    the store are removed. Entries without a time have no day and stay.
    """
    wanted = ["day", *[c for c in entries.columns if c not in _PARTITIONS], *_PARTITIONS[1:]]

    def store(batch: DataFrame, number: int) -> None:
        dated = batch.withColumn("day", F.to_date("ts")).withColumn("batch", F.lit(number))
        writer = dated.select(*wanted).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*_PARTITIONS).parquet(path)
        expire_logs(batch.sparkSession, path, limit)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return entries.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _newest(stored: DataFrame) -> Column:
    """Time of the newest entry: only the last day's files are read for it."""
    last = stored.agg(F.max("day")).first()[0]
    return F.lit(stored.where(F.col("day") == F.lit(last)).agg(F.max("ts")).first()[0]).cast("timestamp")


def expire_logs(spark: SparkSession, path: str, limit: str = LATE_LIMIT) -> list[str]:
    """Remove the folders of days that ended ``limit`` before the newest entry; returns their names."""
    stored = spark.read.parquet(path)
    edge = stored.sparkSession.range(1).select((_newest(stored) - F.expr(f"INTERVAL {limit}")).alias("edge")).first()["edge"]
    if edge is None:
        return []
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        day = name.removeprefix("day=")
        # A day ends where the next one begins, so the edge's own day is kept.
        if name.startswith("day=") and len(day) == 10 and day < edge.strftime("%Y-%m-%d"):
            files.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)


def stored_logs(spark: SparkSession, path: str, limit: str = LATE_LIMIT) -> DataFrame:
    """Entries of the store no older than ``limit`` before the newest one, and those without a time."""
    stored = spark.read.parquet(path)
    edge = _newest(stored) - F.expr(f"INTERVAL {limit}")
    return stored.where(F.col("ts").isNull() | ((F.col("day") >= F.to_date(edge)) & (F.col("ts") >= edge)))
