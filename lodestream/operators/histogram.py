"""Fixed-bound cumulative histograms and quantiles read from them.

A histogram is one column of plain counts per bound, so it adds up across
tasks, windows and micro-batches like any other sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed upper bounds of the exported histograms.
LATENCY_BOUNDS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
INFERENCE_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0)
BATCH_SIZE_BOUNDS = (1.0, 2.0, 5.0, 10.0, 20.0, 32.0, 50.0, 100.0)
SCORE_BOUNDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


def bucket_columns(value: Column, bounds: Sequence[float], prefix: str = "le") -> dict[str, Column]:
    """Aggregates ``<prefix>_0..m``: cumulative counts, the last one is +Inf."""
    counts = {f"{prefix}_{i}": F.count_if(value <= b) for i, b in enumerate(bounds)}
    counts[f"{prefix}_{len(bounds)}"] = F.count(value)
    return counts


def bucket_counts(bounds: Sequence[float], prefix: str = "le") -> list[Column]:
    return [F.col(f"{prefix}_{i}").cast("double") for i in range(len(bounds) + 1)]


def bucket_labels(bounds: Sequence[float]) -> list[str]:
    return [str(float(b)) for b in bounds] + ["+Inf"]


def histogram(events: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Rows (by…, le, bucket_count, total_sum, total_count)."""
    v = F.col(value)
    counted = events.groupBy(*by).agg(
        *[c.alias(n) for n, c in bucket_columns(v, bounds).items()], F.sum(v).alias("total_sum"), F.count(v).alias("total_count")
    )
    return long_buckets(counted, bounds, [*by, "total_sum", "total_count"])


def long_buckets(counted: DataFrame, bounds: Sequence[float], keep: Sequence[str], prefix: str = "le") -> DataFrame:
    rows = F.array(
        *[
            F.struct(F.lit(label).alias("le"), F.col(f"{prefix}_{i}").alias("bucket_count"))
            for i, label in enumerate(bucket_labels(bounds))
        ]
    )
    return counted.select(*keep, F.inline(rows))


def quantile(counts: Sequence[Column], bounds: Sequence[float], q: float) -> Column:
    """Linear interpolation inside the first bucket that reaches q·n.

    The first bucket starts at 0 (or is the point of its bound when that is
    not positive), the +Inf bucket answers the last finite bound, an empty
    histogram answers null.

    Cumulative counts ascend, so that bucket's index is how many counts lie
    below the target. Written without branches: the shared parts are computed
    once and the generated method stays small enough to be compiled.
    """
    total = counts[-1]
    target = total * q
    index = sum(((c < target).cast("int") for c in counts[:-1]), F.lit(0))
    edges = [float(b) for b in bounds]
    starts = [0.0, *edges[:-1]] if edges[0] > 0 else [edges[0], *edges[:-1]]
    width = [upper - lower for lower, upper in zip(starts, edges)]
    at = lambda values, i: F.get(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), i)
    below = F.coalesce(at(counts, index - 1), F.lit(0.0))
    share = F.coalesce((target - below) / F.nullif(at(counts, index) - below, F.lit(0.0)), F.lit(0.0))
    value = at([*starts, edges[-1]], index) + at([*width, 0.0], index) * share
    return value + F.nullif(total, F.lit(0.0)) * 0
