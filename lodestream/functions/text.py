"""Text expressions: tokens, previews, metric names, log lines, defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Whitespace tokens of the whole text; blank or null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"\s+"), "")


def preview(text: Column, width: int = 200) -> Column:
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("..."))).otherwise(text)


def metric_key(name: Column) -> Column:
    """``recall@5`` → ``recall_at_5``, as run trackers want it."""
    return F.replace(name, F.lit("@"), F.lit("_at_"))


def log_fields(line: Column) -> Column:
    """``ts - logger - LEVEL - message`` → struct, with tail defaults.

    A line that does not match keeps its text as the message at level ``info``.
    """
    pattern = r"(?s)^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)(?:,\d+)? - (\S+) - ([A-Z]+) - (.*)$"
    part = lambda i: F.nullif(F.regexp_extract(line, pattern, i), F.lit(""))
    matched = line.rlike(pattern)
    return F.struct(
        F.try_to_timestamp(part(1), F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
        part(2).alias("logger"),
        F.coalesce(part(3), F.lit("info")).alias("level"),
        F.coalesce(F.when(matched, F.regexp_extract(line, pattern, 4)).otherwise(line), F.lit("")).alias("message"),
    )


def log_defaults(level: Column, message: Column) -> tuple[Column, Column]:
    return F.coalesce(level, F.lit("info")), F.coalesce(message, F.lit(""))
