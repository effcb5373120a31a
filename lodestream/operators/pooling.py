"""Pooling of token vectors (doc_id, pos, mask, vec) to one vector per text."""

from __future__ import annotations

import sys

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _summed(vector: Column) -> Column:
    """Sum of array vectors, one mergeable accumulator per task and group."""
    return vector_to_array(Summarizer.sum(array_to_vector(vector)))


def mean_pool(token_rows: DataFrame) -> DataFrame:
    """Masked mean; an all-zero mask gives the zero vector."""
    mask = F.col("mask").cast("double")
    total, weight = _summed(F.transform("vec", lambda v: v.cast("double") * mask)), F.greatest(F.sum(mask), F.lit(1e-9))
    pooled = token_rows.groupBy("doc_id").agg(total.alias("total"), weight.alias("weight"))
    return pooled.select("doc_id", F.transform("total", lambda v: v / F.col("weight")).alias("embedding"))


def max_pool(token_rows: DataFrame) -> DataFrame:
    """Largest unmasked value per dimension; 0 when everything is masked."""
    least = F.lit(-sys.float_info.max)
    vector = F.transform("vec", lambda v: F.when(F.col("mask") > 0, v.cast("double")).otherwise(least))
    top = vector_to_array(Summarizer.max(array_to_vector(vector)))
    pooled = token_rows.groupBy("doc_id").agg(top.alias("top"), F.max("mask").alias("any"))
    return pooled.select("doc_id", F.transform("top", lambda v: F.when(F.col("any") > 0, v).otherwise(0.0)).alias("embedding"))


def first_token_pool(token_rows: DataFrame) -> DataFrame:
    return token_rows.groupBy("doc_id").agg(F.min_by("vec", "pos").alias("embedding"))
