"""Training losses as measurements over a table of scores or vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.operators.topk import _matrix
from lodestream.session import checkpoint_dir

_BLOCK = 1024


def bce_from_logits(pairs: DataFrame, logit: str = "logit", label: str = "label") -> DataFrame:
    z, y = F.col(logit), F.col(label)
    return pairs.agg(F.avg(F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))).alias("loss"))


def margin_loss(pairs: DataFrame, pos: str = "pos_score", neg: str = "neg_score", margin: float = 0.5) -> DataFrame:
    return pairs.agg(F.avg(F.greatest(F.lit(0.0), F.col(neg) - F.col(pos) + margin)).alias("loss"))


def inbatch_softmax(
    pairs: DataFrame,
    *,
    batch: str = "batch_id",
    key: str = "row_id",
    query: str = "query_vec",
    positive: str = "positive_vec",
    scale: float = 20.0,
    block_rows: int = _BLOCK,
) -> DataFrame:
    """(batch_id, rows, loss): mean over rows of logsumexp_j(s·q_i·p_j) − s·q_i·p_i.

    A batch above ``block_rows`` is cut into a grid of blocks; a block returns
    one (max, scaled sum) per row, and these merge exactly, so no batch size
    makes a task unbounded and no pair is ever a row.
    """
    rows = pairs.select(
        F.col(batch).cast("bigint").alias("batch_id"), F.col(key).cast("bigint").alias("row_id"),
        F.col(query).alias("q"), F.col(positive).alias("p"),
    )
    blocks = rows.groupBy("batch_id").agg(F.ceil(F.count("*") / F.lit(block_rows)).cast("int").alias("nb"))
    cut = rows.join(blocks, "batch_id").withColumn("blk", F.pmod(F.xxhash64("row_id"), "nb").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("nb") - 1))
    left = cut.select("batch_id", "row_id", "q", F.col("blk").alias("lblk"), every.alias("rblk"))
    right = cut.select(
        F.col("batch_id").alias("batch_r"), F.col("row_id").alias("row_r"), "p", every.alias("lblk_r"), F.col("blk").alias("rblk_r")
    )
    schema = "batch_id bigint, row_id bigint, m double, s double, own double"

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        ids = a.column("row_id").to_numpy()
        m = s = own = np.empty(0)
        if a.num_rows and b.num_rows:
            logits = scale * (_matrix(a.column("q")) @ _matrix(b.column("p")).T)
            m = logits.max(axis=1)
            s = np.exp(logits - m[:, None]).sum(axis=1)
            same = ids[:, None] == b.column("row_r").to_numpy()[None, :]
            own = np.where(same.any(axis=1), (logits * same).sum(axis=1), np.nan)
        else:
            ids = ids[:0]
        batch_ids = a.column("batch_id").to_numpy()[: len(ids)]
        return pa.table(
            {"batch_id": pa.array(batch_ids, pa.int64()), "row_id": pa.array(ids, pa.int64()), "m": m, "s": s,
             "own": pa.array(own, pa.float64(), from_pandas=True)}
        )

    cells = left.groupBy("batch_id", "lblk", "rblk").cogroup(right.groupBy("batch_r", "lblk_r", "rblk_r"))
    parts = cells.applyInArrow(cell, schema)
    merged = parts.groupBy("batch_id", "row_id").agg(
        F.max("m").alias("top"), F.collect_list(F.struct("m", "s")).alias("parts"), F.max("own").alias("own")
    )
    scaled = F.transform("parts", lambda x: x["s"] * F.exp(x["m"] - F.col("top")))
    lse = F.col("top") + F.log(F.aggregate(scaled, F.lit(0.0), lambda a, x: a + x))
    return merged.groupBy("batch_id").agg(F.count("*").alias("rows"), F.avg(lse - F.col("own")).alias("loss"))


def epoch_loss(batch_losses: DataFrame) -> DataFrame:
    """Mean over batches, not over rows."""
    return batch_losses.agg(F.avg("loss").alias("loss"))


def caches(sizes: DataFrame, cache_size: int, batch: str = "batch_id", n: str = "n") -> DataFrame:
    """(batch, cache_id): consecutive batches fill a cache until it holds at least ``cache_size`` rows.

    ``sizes`` has one row per batch. Where a cache ends depends on all batches before it. So each range of
    batches is first turned into a function from the rows a cache holds at its start to those at its end
    and the caches closed in between, for all ``cache_size`` possible starts at once; the functions, one per range, are
    followed from range to range, and then every range numbers its own batches.
    """
    spark = sizes.sparkSession
    # Ranges come from a sample, so they are written before they are used twice.
    checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        sizes.select(F.col(batch).cast("bigint").alias("batch"), F.col(n).cast("bigint").alias("n"))
        .repartitionByRange(parts, "batch").sortWithinPartitions("batch").withColumn("part", F.spark_partition_id()).checkpoint()
    )

    def summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, closed, part, first = np.arange(cache_size), np.zeros(cache_size, np.int64), None, None
        for frame in frames:
            for size in frame["n"].tolist():
                held = held + size
                full = held >= cache_size
                held[full] = 0
                closed += full
            if len(frame):
                part = int(frame["part"].iloc[0])
                first = int(frame["batch"].iloc[0]) if first is None else first
        if part is not None:
            yield pd.DataFrame({"part": [part], "first": [first], "held": [held.tolist()], "closed": [closed.tolist()]})

    entry, held, number = {}, 0, 0
    # One short list per range, as many as there are partitions.
    for row in sorted(ranged.mapInPandas(summarise, "part int, first bigint, held array<bigint>, closed array<bigint>").collect(), key=lambda r: r["first"]):
        entry[row["part"]] = held, number
        held, number = row["held"][held], number + row["closed"][held]
    starts = spark.sparkContext.broadcast(entry)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = None
        for frame in frames:
            out = []
            for at, size, part in frame[["batch", "n", "part"]].itertuples(index=False):
                held, number = starts.value[part] if state is None else state
                out.append((at, number))
                held += size
                state = (0, number + 1) if held >= cache_size else (held, number)
            yield pd.DataFrame(out, columns=["batch", "cache_id"])

    return ranged.mapInPandas(assign, "batch bigint, cache_id bigint")


def cached_inbatch_softmax(pairs: DataFrame, *, batch: str = "batch_id", cache_size: int = 1024, **columns) -> DataFrame:
    """The in-batch loss over caches of consecutive batches, whatever their sizes.

    Batches fill a cache until it holds at least ``cache_size`` rows; a cache that never fills has no loss (null).
    """
    numbered = caches(pairs.groupBy(batch).agg(F.count("*").alias("n")), cache_size, batch)
    cached = pairs.join(numbered, pairs[batch] == numbered["batch"]).withColumnRenamed("cache_id", "_cache").drop("batch")
    losses = inbatch_softmax(cached, batch="_cache", **columns).withColumnRenamed("batch_id", "cache_id")
    return losses.withColumn("loss", F.when(F.col("rows") >= cache_size, F.col("loss")))
