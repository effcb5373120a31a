"""Seeded splits, samples and shuffles that do not depend on partitioning.

A row's place in a seeded permutation is the rank of (hash of its key, key). Hashes
are uniform, so a count per leading bits of the hash (at most 2^20 numbers, whatever
the table's size) tells where every place lies. Splits and samples need only the few
places where they cut: the cut's bits are narrowed down to one (hash, key), and each row is
then compared with it where it stands. Only a full ranking moves anything, the keys
by themselves, and the places are joined back.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions.hashing import SPAN, hash32

# Leading bits of a hash that are counted, and rows aimed at per bucket of a full ranking.
COUNTED_BITS = 20
LEAST_BITS = 6
BUCKET_ROWS = 1 << 18


def hash_split(
    df: DataFrame, key: str, train: float = 0.7, val: float = 0.2, test: float = 0.1, seed: int = 42
) -> DataFrame:
    """Two-stage split by hash: map-only, stable when rows are added."""
    held_out = val + test
    first = hash32(seed, key) < int(SPAN * (1 - held_out))
    second = hash32(seed + 1, key) < int(SPAN * test / held_out)
    return df.withColumn("split", F.when(first, "train").when(second, "test").otherwise("val"))


@dataclass
class Radix:
    """Row counts by the leading bits of the hash, in one pass over the keys."""

    df: DataFrame
    key: str
    seed: int | str
    before: np.ndarray  # rows before each bucket, and in the end all rows

    @classmethod
    def of(cls, df: DataFrame, key: str, seed: int | str) -> Radix:
        bits = F.shiftrightunsigned(hash32(seed, key), 32 - COUNTED_BITS).cast("int")
        counted = df.select(bits.alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).toPandas()
        counts = np.zeros(1 << COUNTED_BITS, np.int64)
        counts[counted["bucket"].to_numpy(np.int64)] = counted["n"]
        return cls(df, key, seed, np.concatenate([[0], np.cumsum(counts)]))

    @property
    def rows(self) -> int:
        return int(self.before[-1])

    def _hash(self) -> Column:
        return hash32(self.seed, self.key)

    def below(self, place: int) -> Column:
        """True for exactly the rows at places less than ``place``.

        The bucket that holds the place is counted by whole hashes (at most 2^12), and
        the few keys that share the hash are looked at one by one.
        """
        if place <= 0:
            return F.lit(False)
        if place >= self.rows:
            return F.lit(True)
        bucket = int(np.searchsorted(self.before, place, side="right")) - 1
        left = place - int(self.before[bucket])
        if not left:
            return self._hash() < bucket << 32 - COUNTED_BITS
        hashed = self.df.select(self._hash().alias("h"), F.col(self.key).alias("k"))
        inside = hashed.where(F.shiftrightunsigned("h", 32 - COUNTED_BITS) == bucket)
        for row in sorted(inside.groupBy("h").agg(F.count("*").alias("n")).collect()):
            if left < row["n"]:
                break
            left -= row["n"]
        edge = F.lit(row["h"])
        if not left:
            return self._hash() < edge
        equal = inside.where(F.col("h") == edge).orderBy("k").limit(left + 1).collect()[left]["k"]
        return (self._hash() < edge) | ((self._hash() == edge) & (F.col(self.key) < F.lit(equal)))


def seeded_rank(df: DataFrame, key: str, seed: int | str = 42, out: str = "pos") -> DataFrame:
    """0-based position of every row in the seeded permutation of a unique key.

    Only (hash, key) is shuffled and sorted, in buckets whose number grows with
    the table (64 at least); the positions are joined back by key.
    """
    radix = Radix.of(df, key, seed)
    bits = min(COUNTED_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, radix.rows / BUCKET_ROWS)))))
    starts = radix.before[:-1][:: 1 << COUNTED_BITS - bits]
    # At most 2^20 pairs of numbers, so they may be sent to every task.
    offsets = df.sparkSession.createDataFrame(pd.DataFrame({"_bucket": np.arange(1 << bits), "_before": starts}))
    keys = df.select(F.col(key).alias("_key"), hash32(seed, key).alias("_hash")).withColumn("_bucket", F.shiftrightunsigned("_hash", 32 - bits))
    inside = Window.partitionBy("_bucket").orderBy("_hash", "_key")
    local = keys.withColumn("_local", F.row_number().over(inside) - 1)
    places = local.join(F.broadcast(offsets), "_bucket").select("_key", (F.col("_before") + F.col("_local")).alias("_place"))
    return df.join(places, df[key].eqNullSafe(places["_key"])).select(*[df[c] for c in df.columns], F.col("_place").alias(out))


def exact_split(
    df: DataFrame, key: str, train: float = 0.7, val: float = 0.2, test: float = 0.1, seed: int = 42
) -> DataFrame:
    """Split with the sizes of a two-step hold-out: ceil of each held-out part.

    One counting pass finds the two cuts; no row is moved.
    """
    radix = Radix.of(df, key, seed)
    n = radix.rows
    n_held = math.ceil(round(n * (val + test), 9))
    n_test = math.ceil(round(n_held * test / (val + test), 9))
    return df.withColumn("split", F.when(radix.below(n - n_held), "train").when(radix.below(n - n_test), "val").otherwise("test"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows chosen by seed; all rows when there are fewer. No row is moved."""
    return df.where(Radix.of(df, key, seed).below(n))


def seeded_shuffle(df: DataFrame, key: str, seed: int = 42, epoch: int = 0) -> DataFrame:
    """Position of every row in the given epoch's order."""
    return seeded_rank(df, key, f"{seed}:{epoch}")


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


def with_batches(df: DataFrame, key: str, batch_size: int, seed: int = 42, epoch: int = 0) -> DataFrame:
    """Batch number of every row in the epoch's shuffled order."""
    shuffled = seeded_rank(df, key, f"{seed}:{epoch}", out="_pos")
    return shuffled.withColumn("batch_id", F.floor(F.col("_pos") / batch_size).cast("bigint")).drop("_pos")


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))
