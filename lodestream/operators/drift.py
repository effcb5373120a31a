"""Drift of embeddings against a baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.functions.vector import cosine


def _mean(vector: str) -> Column:
    # One mergeable vector accumulator per task and group; no row per dimension.
    return vector_to_array(Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>"))))


def _sum(vector: Column) -> Column:
    return Summarizer.sum(vector)


def baseline_mean(baseline: DataFrame, vector: str = "embedding") -> list[float]:
    """Mean vector of a table: one row of the vectors' width comes back."""
    return list(baseline.agg(_mean(vector).alias("m")).first()["m"] or [])


def drift_windows(
    events: DataFrame,
    baseline: list[float],
    by: Sequence[str] = (),
    vector: str = "embedding",
    threshold: float = 0.1,
    length: str = "1 hour",
    step: str = "1 hour",
    part: str = "30 seconds",
) -> DataFrame:
    """(window_start, window_end, by…, n, drift, drifted) per window of event time ``ts``.

    Vectors are added up in parts of ``part`` first, one mergeable accumulator per
    task and part, and the sums are added to the windows that hold the part. ``drift`` is
    the cosine distance of a window's mean vector to the baseline's. The same plan serves a table and a
    stream with a watermark, which reports a window once it has passed its end.
    """
    as_vector = array_to_vector(F.col(vector).cast("array<double>"))
    parts = events.where(F.col(vector).isNotNull()).groupBy(F.window("ts", part).alias("w"), *by).agg(
        F.count("*").alias("n"), _sum(as_vector).alias("_sum")
    )
    windows = parts.groupBy(F.window(F.window_time("w"), length, step).alias("w"), *by).agg(
        F.sum("n").alias("n"), _sum(F.col("_sum")).alias("_sum")
    )
    reference = F.array(*[F.lit(float(b)) for b in baseline])
    measured = windows.withColumn("drift", 1 - cosine(vector_to_array("_sum"), reference))
    return measured.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, "n", "drift", (F.col("drift") > threshold).alias("drifted")
    )


def embedding_drift(
    baseline: DataFrame, current: DataFrame, by: str, vector: str = "embedding", threshold: float = 0.1
) -> DataFrame:
    """Cosine distance of each group's mean vector to the baseline's mean."""
    reference = baseline.agg(_mean(vector).alias("m"))
    means = current.groupBy(by).agg(F.count("*").alias("n"), _mean(vector).alias("mean_vector"))
    distance = 1 - cosine(F.col("mean_vector"), F.col("baseline_mean"))
    measured = means.withColumn("baseline_mean", reference.scalar()).withColumn("drift", distance)
    return measured.select(by, "n", "drift", (F.col("drift") > threshold).alias("drifted"))
