"""Stream sources: request events and log files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream import schemas
from lodestream.operators import logs


def request_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Request events as they arrive in a folder."""
    reader = spark.readStream.schema(schemas.REQUEST_EVENT).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def kafka_requests(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The same events as JSON records of a Kafka topic (needs the connector)."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schemas.REQUEST_EVENT).alias("e")).select("e.*")


def log_stream(spark: SparkSession, pattern: str, job: str, max_files: int | None = None) -> DataFrame:
    """Parsed lines of the log files matching a glob, labelled by file name."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    lines = reader.load(pattern).withColumn(
        "endpoint", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.log$", 1)
    )
    return logs.with_defaults(logs.parse_lines(lines)).withColumn("job", F.lit(job))
