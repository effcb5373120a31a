"""Running sums over a globally sorted table without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, order: str, sums: list[str], bounds: list[float]) -> DataFrame:
    """Add ``<col>_before``: the sum over all rows with a smaller ``order`` value.

    ``order`` must be unique. ``bounds`` (a fixed, short list, e.g. approximate
    quantiles) cut the rows into ranges; each range is summed by its own task
    and shifted by the totals of the ranges below, of which there are only
    ``len(bounds) + 1``.
    """
    cuts = sorted(set(bounds))
    zone = F.size(F.filter(F.array(*[F.lit(float(b)) for b in cuts]), lambda b: b <= F.col(order))) if cuts else F.lit(0)
    zoned = df.withColumn("_zone", zone)
    totals = zoned.groupBy("_zone").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    below = Window.orderBy("_zone").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_zone", *[F.coalesce(F.sum(f"_t_{c}").over(below), F.lit(0)).alias(f"_o_{c}") for c in sums])
    inside = Window.partitionBy("_zone").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    joined = zoned.join(F.broadcast(offsets), "_zone")
    for c in sums:
        joined = joined.withColumn(f"{c}_before", F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)))
    return joined.drop("_zone", *[f"_o_{c}" for c in sums])


def quantile_bounds(df: DataFrame, col: str, zones: int = 256) -> list[float]:
    """At most ``zones - 1`` approximate quantiles; one pass, a short list back."""
    probabilities = [i / zones for i in range(1, zones)]
    return df.approxQuantile(col, probabilities, 1 / (4 * zones))
