"""Log lines: parsing, defaults, labels, error tails."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.functions.text import log_defaults, log_fields


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    rest = [c for c in lines.columns if c != value]
    return lines.select(*rest, log_fields(F.col(value)).alias("_f")).select(*rest, "_f.*")


def with_defaults(entries: DataFrame) -> DataFrame:
    level, message = log_defaults(F.col("level"), F.col("message"))
    return entries.withColumns({"level": level, "message": message})


def labelled(entries: DataFrame, job: str, endpoint: str) -> DataFrame:
    return entries.withColumns({"job": F.lit(job), "endpoint": F.lit(endpoint)})


def errors(entries: DataFrame, text: str = "ERROR") -> DataFrame:
    """Entries whose level or message holds the text (the line filter)."""
    return entries.where(F.col("message").contains(text) | F.col("level").contains(text))


def error_tail(entries: DataFrame, limit: int = 100, text: str = "ERROR") -> DataFrame:
    """Most recent matching entries first (a top-k report)."""
    return errors(entries, text).orderBy(F.col("ts").desc(), F.col("message")).limit(limit)
