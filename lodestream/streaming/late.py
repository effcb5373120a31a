"""Late events of a stream: split off, counted and kept beside the others."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestream.streaming.telemetry import LATE_LIMIT

_COUNTS = "batch bigint, kept bigint, late bigint, newest timestamp"


def _read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts per micro-batch; none before the first one."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/counts")
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], _COUNTS)
    return spark.read.schema(_COUNTS).parquet(f"{path}/counts")


def split_late(
    events: DataFrame, path: str, checkpoint: str, limit: str = LATE_LIMIT, *, time: str = "ts", trigger: dict | None = None
) -> StreamingQuery:
    """Write every event to ``path/events``, with ``late`` telling those that would be rejected.

    An event is late if it is older than the newest one of all micro-batches before
    its own by more than ``limit``; an event without a time is late, too. Each
    micro-batch is one folder, written once in one pass that also counts it, and a row
    of ``path/counts`` (batch, kept, late, newest). A batch that is run again after a failure
    sees the same newest time and overwrites its folder, so both stay exact.
    """

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = _read_counts(spark, path).where(F.col("batch") < number).agg(F.max("newest")).first()[0]
        stamp = F.col(time).cast("timestamp")
        if known is None:
            late = stamp.isNull()
        else:
            late = F.coalesce(stamp < F.lit(known) - F.expr(f"INTERVAL {limit}"), F.lit(True))
        seen = Observation()
        told = batch.withColumn("late", late).observe(
            seen, F.count_if(~F.col("late")).alias("kept"), F.count_if(F.col("late")).alias("late"), F.max(stamp).alias("newest")
        )
        told.write.mode("overwrite").partitionBy("late").parquet(f"{path}/events/batch={number}")
        got = seen.get
        newest = max((t for t in (known, got["newest"]) if t is not None), default=None)
        row = spark.createDataFrame([(number, got["kept"], got["late"], newest)], _COUNTS)
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts/part={number}")

    writer = events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def late_counts(spark: SparkSession, path: str) -> DataFrame:
    """(batch, kept, late, newest) of every micro-batch written so far."""
    return _read_counts(spark, path).select("batch", "kept", "late", "newest")


def stored_events(spark: SparkSession, path: str, late: bool) -> DataFrame:
    """The events kept, or those rejected, with the number of their ``batch``."""
    return spark.read.parquet(f"{path}/events").where(F.col("late") == late).drop("late")
