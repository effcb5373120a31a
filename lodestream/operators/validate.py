"""Schema and content checks with a verdict per table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRAIN_COLUMNS = ("question", "context", "cid", "qid")
CORPUS_COLUMNS = ("text", "cid")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail on the schema, before any job starts."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def is_numeric(df: DataFrame, column: str) -> bool:
    kind = df.schema[column].dataType
    if isinstance(kind, T.ArrayType):
        kind = kind.elementType
    return isinstance(kind, T.NumericType)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One pass, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "nulls")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of their key; null counts as one key."""
    # Pre-aggregating per key keeps a hot key to one row per task.
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def table_verdict(df: DataFrame, name: str, required: Sequence[str], *, nulls_fail: bool, numeric_key: bool) -> DataFrame:
    """(table_name, row_count, null_values, valid): missing columns and a
    non-numeric key always fail; nulls fail only where asked."""
    spark = df.sparkSession
    row = "table_name string, row_count bigint, null_values bigint, valid boolean"
    if missing_columns(df, required):
        return spark.createDataFrame([(name, None, None, False)], row)
    typed = is_numeric(df, "cid") if numeric_key else True
    nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in required])
    stats = df.agg(F.count("*").alias("row_count"), nulls.alias("null_values"))
    clean = (F.col("null_values") == 0) if nulls_fail else F.lit(True)
    return stats.select(F.lit(name).alias("table_name"), "row_count", "null_values", (clean & F.lit(typed)).alias("valid"))


def validation_verdict(train: DataFrame, corpus: DataFrame) -> DataFrame:
    """A row per table and a last row for the whole set."""
    tables = table_verdict(train, "train", TRAIN_COLUMNS, nulls_fail=False, numeric_key=True).unionByName(
        table_verdict(corpus, "corpus", CORPUS_COLUMNS, nulls_fail=True, numeric_key=False)
    )
    overall = tables.agg(
        F.lit("all").alias("table_name"),
        F.sum("row_count").alias("row_count"),
        F.sum("null_values").alias("null_values"),
        F.bool_and("valid").alias("valid"),
    )
    return tables.unionByName(overall)
