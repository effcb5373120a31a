"""Request telemetry: counters, gauges, rates, latency and cost over events.

Every windowed metric is the same two-step plan for a batch and a stream:
count into tumbling windows of one step, then add the steps of the sliding
window. The sliding copies are made of the pre-counted rows, not of events,
and a hot endpoint reaches the shuffle as one row per step and task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.operators.histogram import LATENCY_BOUNDS, bucket_counts, bucket_columns, long_buckets, quantile

STEP = "30 seconds"


def sliding(
    events: DataFrame,
    by: Sequence[str],
    partials: Mapping[str, Column],
    length: str,
    step: str = STEP,
    merge: Mapping[str, Callable[[str], Column]] | None = None,
    keep: str | None = None,
) -> DataFrame:
    """(window_start, window_end, by…, partials…) over windows [start, end).

    ``partials`` are aggregates of one step; they are merged by sum unless
    ``merge`` gives another aggregate. A window without events has no row. With
    ``keep`` the window stays a column of that name, for further event-time steps.
    """
    merge = merge or {}
    stepped = events.groupBy(F.window("ts", step).alias("w"), *by).agg(*[c.alias(n) for n, c in partials.items()])
    rolled = stepped.groupBy(F.window(F.window_time("w"), length, step).alias("w"), *by).agg(
        *[merge.get(n, F.sum)(n).alias(n) for n in partials]
    )
    if keep:
        return rolled.select(F.col("w").alias(keep), *by, *partials)
    return rolled.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, *partials)


def seconds_of(length: str) -> float:
    number, unit = length.split()
    return float(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


# --- counters and gauges ----------------------------------------------------


def request_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("endpoint", "action", "status").agg(F.count("*").alias("requests"))


def last_values(events: DataFrame, by: str = "endpoint") -> DataFrame:
    """Gauges: the latest value of each, ordered by (ts, event_id)."""
    at = F.struct("ts", "event_id")
    return events.groupBy(by).agg(
        *[F.max_by(c, at).alias(f"last_{c}") for c in ("dimension", "score_min", "score_max", "cost")]
    )


def with_score_range(events: DataFrame, scores: str = "scores") -> DataFrame:
    """Smallest and largest score of each request's batch."""
    return events.withColumns({"score_min": F.array_min(scores), "score_max": F.array_max(scores)})


def score_observations(events: DataFrame, scores: str = "scores") -> DataFrame:
    """One row per observed score."""
    return events.withColumn("score", F.explode(scores)).drop(scores)


def cost_summary(events: DataFrame, by: str = "endpoint") -> DataFrame:
    per_request = F.sum("cost") / F.count("*")
    return events.groupBy(by).agg(per_request.alias("cost_per_request"), (1000 * per_request).alias("cost_per_1k"))


def cold_starts(events: DataFrame) -> DataFrame:
    """First request of each (endpoint, worker): a minimum, not a ranking, so a
    busy worker is one row per task."""
    return events.groupBy("endpoint", "worker_id").agg(F.min("ts").alias("ts"))


def banded(value: Column, steps: Sequence[tuple[float, str]]) -> Column:
    """Name of the last step whose start is not above the value.

    ``steps`` ascend; the first one has no lower limit.
    """
    ordered = list(steps)
    out = F.lit(ordered[0][1])
    for start, name in ordered[1:]:
        out = F.when(value >= start, name).otherwise(out)
    return F.when(value.isNotNull(), out)


# --- sliding windows ---------------------------------------------------------


def request_rate(events: DataFrame, length: str = "1 minute") -> DataFrame:
    counted = sliding(events, ["endpoint", "action", "status"], {"n": F.count("*")}, length)
    return counted.withColumn("rate", F.col("n") / seconds_of(length)).drop("n")


def success_rate(events: DataFrame, length: str = "5 minutes") -> DataFrame:
    parts = {"ok": F.count_if(F.col("status") == "success"), "n": F.count("*")}
    counted = sliding(events, ["endpoint", "action"], parts, length)
    rate = F.col("ok") / F.col("n")
    return counted.withColumns({"success_rate": rate, "error_rate": 1 - rate}).drop("ok", "n")


def average_latency(events: DataFrame, length: str = "5 minutes", value: str = "duration_s") -> DataFrame:
    counted = sliding(events, ["endpoint", "action"], {"s": F.sum(value), "n": F.count(value)}, length)
    return counted.withColumn("avg_latency", F.col("s") / F.col("n")).drop("s", "n")


def latency_quantiles(
    events: DataFrame,
    length: str = "5 minutes",
    value: str = "duration_s",
    bounds: Sequence[float] = LATENCY_BOUNDS,
    points: Mapping[str, float] | None = None,
) -> DataFrame:
    points = points or {"p50": 0.50, "p95": 0.95, "p99": 0.99}
    counted = sliding(events, ["endpoint", "action"], bucket_columns(F.col(value), bounds), length)
    counts = bucket_counts(bounds)
    return counted.select(
        "window_start", "window_end", "endpoint", "action", *[quantile(counts, bounds, q).alias(n) for n, q in points.items()]
    )


def exact_quantiles(events: DataFrame, by: Sequence[str], value: str = "duration_s", accuracy: int = 10_000) -> DataFrame:
    """Raw-event alternative to the histogram reading."""
    points = F.percentile_approx(value, [0.50, 0.95, 0.99], accuracy)
    summed = events.groupBy(*by).agg(points.alias("p"))
    return summed.select(*by, F.col("p")[0].alias("p50"), F.col("p")[1].alias("p95"), F.col("p")[2].alias("p99"))


def bucket_rates(
    events: DataFrame,
    value: str,
    bounds: Sequence[float],
    by: Sequence[str] = ("endpoint",),
    length: str = "5 minutes",
    step: str = STEP,
) -> DataFrame:
    """Per-second rate of every bucket, long form (panels and heat maps)."""
    counted = sliding(events, list(by), bucket_columns(F.col(value), bounds), length, step)
    rows = long_buckets(counted, bounds, ["window_start", "window_end", *by])
    return rows.withColumn("rate", F.col("bucket_count") / seconds_of(length)).drop("bucket_count")


def inference_load(events: DataFrame, action: str = "rerank", length: str = "5 minutes") -> DataFrame:
    """Inference seconds spent per second."""
    chosen = events.where(F.col("action") == action)
    counted = sliding(chosen, ["endpoint"], {"s": F.sum("inference_s")}, length)
    return counted.withColumn("inference_load", F.col("s") / seconds_of(length)).drop("s")


def cold_start_rate(starts: DataFrame, length: str = "1 hour", step: str = STEP) -> DataFrame:
    """Increase and per-second rate of cold starts."""
    counted = sliding(starts, ["endpoint"], {"increase": F.count("*")}, length, step)
    return counted.withColumn("rate", F.col("increase") / seconds_of(length))


def score_spread(events: DataFrame, length: str = "5 minutes", value: str = "score") -> DataFrame:
    """Population standard deviation of scores per window."""
    v = F.col(value)
    parts = {"s": F.sum(v), "ss": F.sum(v * v), "n": F.count(v)}
    counted = sliding(events, ["endpoint"], parts, length)
    mean = F.col("s") / F.col("n")
    spread = F.sqrt(F.greatest(F.col("ss") / F.col("n") - mean * mean, F.lit(0.0)))
    return counted.withColumn("score_stddev", spread).drop("s", "ss", "n")


def late_split(events: DataFrame, now: Column, limit: str = "168 hours") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) by age at ingestion."""
    old = F.col("ts") < now - F.expr(f"INTERVAL {limit}")
    return events.where(~old), events.where(old)
