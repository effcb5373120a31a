"""Mixing sources to target weights by systematic sampling.

Within a source every document expects the same number of copies, the ratio of
the source's target to its size. Documents are put in order of size, the
expected copies are summed along that order, one random offset per source is
added, and a document is emitted once for each whole number that its step
crosses. As neighbours in the order are about equally long, the words taken
follow the target closely, and no document exceeds the rounded-up ratio.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions.hashing import hash32
from lodestream.llm.shared import WORD, cut, positions, whole

MOST = 3
# Expected copies are whole numbers of this unit, so sums are exact.
UNIT = 1 << 24


def _exact(value: str | int) -> Column:
    """A column or number wide enough for products of sizes and weights."""
    return (F.col(value) if isinstance(value, str) else F.lit(value)).cast("decimal(19,0)")


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.regexp_count(whole(), F.lit(WORD)).cast("bigint").alias("size"))


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, target): sources in code point order, null last,
    weigh 1, 2, 3, repeating, and share the sum of all sizes; a target stops at
    ``most`` times its source's size and the excess is shared again by weight."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = positions(totals.withColumn("_last", F.col("source").isNull()).withColumn("_all", F.lit(0)), ["_all"], ["_last", "source"])
    weighed = ranked.select("source", "source_size", (F.col("_pos") % 3 + 1).alias("w"), F.lit(False).alias("full"))
    # Each round stops the sources that are above their limit; one row comes back.
    while True:
        weighed = cut(weighed)
        left = F.sum(F.when(F.col("full"), F.col("source_size") * (1 - most)).otherwise(F.col("source_size")))
        share = weighed.agg(left.alias("r"), F.sum(F.when(~F.col("full"), F.col("w"))).alias("w")).first()
        r, w = share["r"] or 0, share["w"] or 1
        above = ~F.col("full") & (_exact("w") * _exact(r) > _exact("source_size") * _exact(most * w))
        if weighed.where(above).isEmpty():
            break
        weighed = weighed.withColumn("full", F.col("full") | above)
    rest = (_exact("w") * _exact(r)).cast("double") / F.lit(w)
    return weighed.select("source", "source_size", F.when(F.col("full"), (F.col("source_size") * most).cast("double")).otherwise(rest).alias("target"))


def copies(docs: DataFrame, seed: int = 17, most: int = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) per row of ``docs``.

    ``size`` counts words; null texts and texts without words have size 0 and add
    nothing to what is taken. A null source is a source of its own. Equal sizes
    are ordered by doc_id (null first); rows equal in source, size and doc_id may
    trade their copies. The result is the same in every run.
    """
    sizes = cut(sized(docs))
    goal = targets(sizes, most).withColumnRenamed("source", "_source")
    ratio = F.when(F.col("source_size") > 0, F.floor(F.col("target") * UNIT / F.col("source_size")).cast("bigint")).otherwise(F.lit(0))
    step = F.least(ratio, F.lit(most * UNIT))
    start = F.floor(hash32(seed, F.coalesce(F.col("source"), F.lit(""))) / ((1 << 32) // UNIT)).cast("bigint")
    placed = positions(sizes, ["source"], ["size", "doc_id"])
    joined = placed.join(goal, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_step", step).withColumn("_start", start)
    crossed = [F.expr(f"(_step * ({p}) + _start) DIV {UNIT}") for p in ("_pos + 1", "_pos")]
    return joined.select("doc_id", "source", "size", "source_size", "target", (crossed[0] - crossed[1]).cast("bigint").alias("copies"))


def mix(docs: DataFrame, seed: int = 17, most: int = MOST) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, same columns.

    Rows that share an id and a size share out their copies evenly.
    """
    plan = copies(docs, seed, most).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("_c"), F.count("*").alias("_m"))
    plan = plan.select(F.struct("doc_id", "source", "size").alias("_key"), "_c", "_m")
    rows = docs.select(
        F.struct("*").alias("_row"),
        F.struct("doc_id", "source", F.regexp_count(whole(), F.lit(WORD)).cast("bigint").alias("size")).alias("_key"),
    )
    # Only keys taken at all meet the texts; rows of a repeated key are numbered.
    met = rows.join(plan.where("_c > 0"), "_key").withColumn("_i", F.row_number().over(Window.partitionBy("_key").orderBy(F.lit(0))))
    times = F.expr("CAST((_c * _i) DIV _m - (_c * (_i - 1)) DIV _m AS INT)")
    return met.select("_row", F.explode(F.array_repeat(F.lit(0), times))).select("_row.*")
