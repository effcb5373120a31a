"""Helpers of this subpackage: lineage cuts, exact positions, components."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestream.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
FILTER_BITS = 1 << 20, 1 << 24


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Like ``cut``, as a compressed table in the shared folder: for wide or many rows."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Identity of a document where ids may be missing or repeated: id and text."""
    return F.struct(F.col(doc_id).alias("id"), F.xxhash64(whole(text)).alias("text"))


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def positions(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Add ``_pos``: the row's place in its group, from 0, by ``order``.

    Rows are dealt out by ranges of (group, order), so that a group with a third
    of the rows is spread over a third of the tasks. Each range numbers its own
    rows; a table of (range, group) counts shifts them. The ranges come from a
    sample, so they are written once before they are used twice. Rows equal in
    all these columns may trade places. Only small rows should be passed in.
    """
    ranged = cut(df.repartitionByRange(tasks(df), *group, *order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range", *group).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col("_range").alias("_r"), *[F.col(g).alias(f"_g_{g}") for g in group], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    numbered = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_range", *group).orderBy(*order)))
    same = F.col("_range") == F.col("_r")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return numbered.join(shifts, same).select(*df.columns, (F.col("_shift") + F.col("_local") - 1).alias("_pos"))


def fixed_table(spark: SparkSession, values: np.ndarray) -> Column:
    """Numbers of a fixed count as an array that every row can look into: a scalar
    subquery, so that it is sent once and does not swell the plan's text."""
    held = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))
    return spark.createDataFrame(pa.table({"held": held})).select("held").scalar()


def present(ids: DataFrame, *columns: str) -> Column:
    """A test that is true for every row with values in ``ids`` (and few others): a bit per
    hash of the columns, in a table of 16 bits or more for each up to a fixed size."""
    least, most = FILTER_BITS
    size = min(most, max(least, 1 << (16 * ids.count()).bit_length()))
    bins = ids.select(F.xxhash64(*columns).bitwiseAND(F.lit(size - 1)).alias("b"))
    one = F.lit(1).cast("bigint")
    words = bins.groupBy(F.shiftright("b", 6).cast("int").alias("w")).agg(F.bit_or(F.call_function("shiftleft", one, F.col("b").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toArrow()
    table = np.zeros(size >> 6, np.int64)
    table[words["w"].to_numpy()] = words["bits"].to_numpy()
    b = F.xxhash64(*columns).bitwiseAND(F.lit(size - 1))
    word = F.get(fixed_table(ids.sparkSession, table), F.shiftright(b, 6).cast("int"))
    return F.call_function("shiftrightunsigned", word, b.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(one) == 1


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node reached.

    Each round a node points at its smallest neighbour, pointers are doubled until
    they rest, and the edges between the roots are the next round's edges, so the
    number of nodes at least halves. Hubs are only ever reduced by a minimum.
    """
    edges = cut(edges.select("u", "v").where("u <> v").distinct())
    nodes = None
    while not edges.isEmpty():
        both = edges.select("u", "v").union(edges.select("v", "u"))
        parent = cut(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("p")).select("node", F.least("node", "p").alias("root")))
        while True:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
            further = cut(parent.join(up, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")))
            moved = not further.where("moved").isEmpty()
            parent = further.select("node", "root")
            if not moved:
                break
        for end in ("u", "v"):
            edges = edges.join(parent.select(F.col("node").alias(end), F.col("root").alias("r")), end).drop(end).withColumnRenamed("r", end)
        edges = cut(edges.where("u <> v").select("u", "v").distinct())
        if nodes is None:
            nodes = parent
        else:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("up"))
            nodes = nodes.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return nodes if nodes is not None else edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
