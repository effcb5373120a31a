"""Near-duplicate groups by SimHash and meet-in-the-middle ball hashing.

Two 64-bit fingerprints at most ``radius`` bits apart have a common point at
most half the radius from either. So every distinct fingerprint is sent to all
points of its half-radius ball; fingerprints that meet at a point are within
``radius`` of each other by the triangle inequality, and a star to the smallest
one links them without writing out pairs. A point can gather no more
fingerprints than its ball has members (65 for radius 2), whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.shared import components, cut, whole

BITS = 64
_CHUNK = 1 << 16


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Hashes of the word shingles of a text, with repeats and in order.

    A-Z are lower-cased; a text with fewer words is one shingle; a text without
    words (or null) has none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(found) - words + 1
    if not found:
        return np.zeros(0, np.uint64)
    if n < 1:
        shingles: Iterator[bytes] = iter([b" ".join(found)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*[found[i:] for i in range(words)]))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), np.uint64, n)


def simhash(text: str | None, words: int = 3) -> int:
    """Bit i is set if it is set in over half the hashes of the word shingles; a text
    without words (or null) has fingerprint 0."""
    hashes = shingle_hashes(text, words)
    n = len(hashes)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, _CHUNK):
        part = hashes[at : at + _CHUNK]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(len(part), BITS).sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(df: DataFrame, words: int = 3, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of a text column as BIGINT (the same 64 bits)."""

    @F.pandas_udf("bigint")
    def fingerprint(texts):
        return texts.map(lambda t: simhash(t, words)).astype("uint64").astype("int64")

    return df.withColumn(name, fingerprint(F.col(text)))


def ball(fingerprint: Column, radius: int) -> Column:
    """All values at most ``radius`` bits from a fingerprint."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BITS), r)]
    return F.array(*[fingerprint.bitwiseXOR(F.lit(m - (1 << 64) if m >= 1 << 63 else m)) for m in masks])


def links(fingerprints: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs within ``radius``.

    ``fingerprints`` has one row per distinct ``fingerprint``.
    """
    if radius < 0 or radius % 2:
        raise ValueError("the radius must be even: half of it is searched from either side")
    spread = fingerprints.select(F.col("fingerprint").alias("u"), F.explode(ball(F.col("fingerprint"), radius // 2)).alias("point"))
    met = spread.withColumn("v", F.min("u").over(Window.partitionBy("point")))
    return met.where((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)).select("u", "v").distinct()


def near_groups(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id among all rows whose fingerprints are
    connected by links, null only if none of them has an id. Null texts count as
    empty ones, and empty ones are linked to each other like any others. Repeated
    rows stay repeated. Other columns of ``docs`` are not looked at.
    """
    marked = cut(with_fingerprint(docs.select("doc_id", "text"), words).select("doc_id", "fingerprint"))
    distinct = cut(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct, radius)).withColumnRenamed("node", "fingerprint")
    placed = distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    best = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = placed.join(best, "root").select("fingerprint", "component_id")
    return marked.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def hexadecimal(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def one_per_group(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, same columns.

    The row with the smallest doc_id stays (null before all others); of rows that
    share it, the one with the smallest text hash, and one of equal rows. Texts
    without words, null ones too, are duplicates of each other like any others.
    """
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64(whole()).alias("t"))
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_key"), "text")
    marked = cut(with_fingerprint(rows, words, name="_f").select("_key", "_f"))
    # The first row of each fingerprint first, so that groups of copies are one row each.
    best = cut(marked.groupBy("_f").agg(F.min("_key").alias("first")))
    roots = components(links(best.select(F.col("_f").alias("fingerprint")), radius))
    placed = best.join(roots, best["_f"] == roots["node"], "left").withColumn("root", F.coalesce("root", "_f"))
    chosen = placed.groupBy("root").agg(F.min("first").alias("_key")).select("_key")
    met = rows.drop("text").join(chosen, "_key")
    return met.groupBy("_key").agg(F.first("_row").alias("_row")).select("_row.*").select(*docs.columns)
