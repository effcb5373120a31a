"""Groups of near copies: texts whose sets of word shingles are at least 0.8 similar.

An exact set-similarity join, so no similar pair is missed. Shingles (hashes of 64
bits) are put in one order for all texts, frequent ones last; two similar sets share
one of the first fifth of their shingles (prefix filter), at places that leave room
for the rest (positional filter), are about equally large (length filter), and share
so many of these first shingles that the rest can make up the overlap. What is left
is verified on the whole sets, and linked texts are one group.

Texts with the same set meet as one. In a list of sets that share a shingle, all
meet if the list is short; in a longer one each first meets the few before it, and
then only sets that are not yet in one group meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.line_dedup import enough, needed
from lodestream.llm.shared import components, cut, present, whole, written
from lodestream.llm.simhash import links as links_within
from lodestream.llm.simhash import shingle_hashes

THRESHOLD = 0.8
# Size of the rarity table, which is counted on every text.
BINS = 1 << 20
# The longest list whose sets all meet, and how many earlier ones are met first in longer ones.
FEW = 64
BEFORE = 4
_LOW = (1 << 31) - 1


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending; none if it has no words."""
    return np.unique(shingle_hashes(text, words))


def rarity_table(docs: DataFrame, words: int) -> np.ndarray:
    """A level per bin of shingle hashes: how frequent its shingles are, on a log scale."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                np.add.at(total, (shingle_set(text.as_py(), words) & np.uint64(BINS - 1)).astype(np.int64), 1)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(total[found], pa.int64())], ["bin", "n"])

    counts = docs.select("text").mapInArrow(count, "bin int, n bigint").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    levels = np.zeros(BINS, np.uint8)
    levels[counts["bin"].to_numpy()] = np.floor(3 * np.log2(counts["n"].to_numpy()) + 1)
    return levels


def with_prefix(docs: DataFrame, words: int, threshold: float) -> DataFrame:
    """Add ``_s``: (f, n, prefix), the set's hash, its size and its rarest shingles, of
    which every set that is similar enough has one among its own."""
    levels, per_mille = rarity_table(docs, words), round(threshold * 1000)

    @F.pandas_udf("f bigint, n int, prefix array<bigint>")
    def measured(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            found = shingle_set(text, words)
            n = len(found)
            level = levels[(found & np.uint64(BINS - 1)).astype(np.int64)]
            first = np.lexsort((found, level))[: n - -(-n * per_mille // 1000) + 1] if n else []
            rows.append((xxhash.xxh64_intdigest(found.tobytes(), 42), n, found[first].view(np.int64) if n else np.zeros(0, np.int64)))
        f, n, prefix = zip(*rows) if rows else ((), (), ())
        return pd.DataFrame({"f": np.array(f, np.uint64).view(np.int64), "n": np.array(n, np.int32), "prefix": pd.Series(prefix, dtype=object)})

    return docs.withColumn("_s", measured("text"))


def may_match(threshold: float) -> Column:
    """Length and positional filters for two sets that share a prefix shingle."""
    np1, np2 = F.col("np"), F.col("np2")
    n, n2 = F.shiftright(np1, 32), F.shiftright(np2, 32)
    p, p2 = np1.bitwiseAND(F.lit(_LOW)), np2.bitwiseAND(F.lit(_LOW))
    overlap = needed(n, n2, threshold)
    return (F.least(n, n2) >= overlap) & (F.least(p, p2) + F.least(n - p, n2 - p2) >= overlap)


def links(best: DataFrame, rows: DataFrame, words: int, threshold: float) -> DataFrame:
    """Edges (u, v) whose components are those of all similar pairs of sets.

    ``best`` has a row per distinct set (f, first, n, prefix); ``rows`` has the texts
    (_key, text), where ``first`` is the key of one with this set.
    """
    at = best.select("f", "n", F.posexplode("prefix").alias("p", "t"))
    own = at.select("t", "f", F.shiftleft(F.col("n").cast("bigint"), 32).bitwiseOR(F.col("p").cast("bigint")).alias("np"))
    listed = cut(own.withColumn("m", F.count("*").over(Window.partitionBy("t"))).where("m > 1"))
    fits = may_match(threshold)
    short, longer = listed.where(F.col("m") <= FEW), listed.where(F.col("m") > FEW)
    met = short.join(short.select("t", F.col("f").alias("f2"), F.col("np").alias("np2")), "t").where((F.col("f2") < F.col("f")) & fits)
    inside = Window.partitionBy("t").orderBy("f")
    before = F.array(*[F.lag(F.struct(F.col("f").alias("f2"), F.col("np").alias("np2")), k).over(inside) for k in range(1, BEFORE + 1)])
    close = longer.withColumn("b", before).select("f", "np", F.explode("b").alias("b")).where("b IS NOT NULL").select("f", "np", "b.f2", "b.np2").where(fits)
    pair = [F.col("f").alias("u"), F.col("f2").alias("v"), F.shiftright("np", 32).alias("n"), F.shiftright("np2", 32).alias("n2")]
    # How many first shingles a pair shares in short lists, and in how many longer ones it met.
    both = met.select(*pair, F.lit(1).alias("in_short")).union(close.select(*pair, F.lit(0).alias("in_short")))
    counted = written(both.groupBy("u", "v", "n", "n2").agg(F.sum("in_short").alias("c")))
    many = longer.groupBy(F.col("f").alias("u")).agg(F.count("*").alias("more"))
    hopeful = counted.join(many, "u", "left").where(enough(F.col("c") + F.coalesce("more", F.lit(0)), threshold))
    found = verified(hopeful, best, rows, words, threshold)
    if longer.isEmpty():
        return found
    # Sets of the longer lists that are not yet in one group.
    placed = longer.join(components(found), F.col("f") == F.col("node"), "left").select("t", "f", "np", F.coalesce("root", "f").alias("root"))
    mixed = placed.groupBy("t").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("t")
    placed = cut(placed.join(mixed, "t"))
    other = placed.select("t", F.col("f").alias("f2"), F.col("np").alias("np2"), F.col("root").alias("root2"))
    far = placed.join(other, "t").where((F.col("f2") < F.col("f")) & (F.col("root") != F.col("root2")) & fits)
    # All their common first shingles: a longer list that holds both is among the mixed ones.
    shared = far.select(*pair, F.lit(1).alias("c"), F.lit(True).alias("far")).union(counted.select("u", "v", "n", "n2", "c", F.lit(False)))
    shared = shared.groupBy("u", "v", "n", "n2").agg(F.sum("c").alias("c"), F.max("far").alias("far")).where("far")
    return found.union(verified(shared.where(enough(F.col("c"), threshold)), best, rows, words, threshold))


def verified(pairs: DataFrame, best: DataFrame, rows: DataFrame, words: int, threshold: float) -> DataFrame:
    """The pairs (u, v), each given once, of set hashes whose sets are similar enough; only
    the texts of these pairs are moved."""

    @F.pandas_udf("array<bigint>")
    def hashes(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(text, words).view(np.int64) for text in texts], dtype=object)

    pairs = cut(pairs.select("u", "v"))
    ends = pairs.select(F.col("u").alias("f")).union(pairs.select(F.col("v").alias("f"))).distinct()
    keys = cut(best.select("f", F.col("first").alias("_key")).join(ends, "f"))
    texts = rows.where(present(keys, "_key")).select("_key", "text").join(keys, "_key").groupBy("f").agg(F.first("text").alias("text"))
    sets = written(texts.select("f", hashes("text").alias("s")))
    both = pairs.join(sets.select(F.col("f").alias("u"), F.col("s").alias("a")), "u").join(sets.select(F.col("f").alias("v"), F.col("s").alias("b")), "v")
    return cut(both.where(F.size(F.array_intersect("a", "b")) >= needed(F.size("a"), F.size("b"), threshold)).select("u", "v"))


def print_links(marked: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) between sets whose texts have fingerprints linked by SimHash; ``marked``
    has the set hash ``f`` and the ``fingerprint`` of every text."""
    both = cut(marked.select("fingerprint", "f").distinct())
    named = cut(both.groupBy("fingerprint").agg(F.min("f").alias("name")))
    same = both.join(named, "fingerprint").select(F.col("f").alias("u"), F.col("name").alias("v"))
    close = links_within(named.select("fingerprint"), radius)
    for end in ("u", "v"):
        close = close.join(named.select(F.col("fingerprint").alias(end), F.col("name").alias(f"_{end}")), end)
    return same.where("u <> v").union(close.select(F.col("_u").alias("u"), F.col("_v").alias("v")))


def one_per_group(docs: DataFrame, words: int = 5, threshold: float = THRESHOLD, fingerprint: str | None = None, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each group of near copies, same columns.

    Near copies are texts with a Jaccard similarity of their sets of word shingles of
    at least ``threshold``; a group holds all that are connected by such pairs. If a column
    ``fingerprint`` is named (see ``simhash``; it is not returned), fingerprints at most ``radius`` bits
    apart connect their texts, too. A-Z are
    lower-cased, a text with fewer words is one shingle, and texts without words, null
    ones too, are copies of each other. The row with the smallest doc_id stays (null
    before all others); of rows that share it, the one with the smallest text hash, and
    one of equal rows.
    """
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64(whole()).alias("t"))
    columns = [c for c in docs.columns if c != fingerprint]
    prints = [F.col(fingerprint).alias("fingerprint")] if fingerprint else []
    rows = docs.select(F.struct(*columns).alias("_row"), key.alias("_key"), "text")
    keyed = docs.select(key.alias("_key"), "text", *prints)
    marked = cut(with_prefix(keyed, words, threshold).drop("text").select("_key", "_s.*", *(["fingerprint"] if prints else [])))
    # Texts with the same set first, so that groups of copies are one row each.
    best = cut(marked.groupBy("f").agg(F.min("_key").alias("first"), F.count("*").alias("rows"), F.min("n").alias("n"), F.first("prefix").alias("prefix")))
    edges = links(best, rows, words, threshold)
    roots = components(edges.union(print_links(marked, radius)) if prints else edges)
    placed = best.select("f", "first", "rows").join(roots, F.col("f") == F.col("node"), "left").withColumn("root", F.coalesce("root", "f"))
    crowded = placed.groupBy("root").agg(F.min("first").alias("chosen"), F.sum("rows").alias("all")).where("all > 1")
    members = placed.select("f", "root").join(crowded, "root").select("f", "chosen")
    keys = cut(marked.select("_key", "f").join(members, "f").select("_key", "chosen").distinct())
    # Rows without a copy stay where they are.
    copied = present(keys, "_key")
    met = rows.drop("text").where(copied).join(keys, "_key", "left").where(F.col("chosen").isNull() | F.col("chosen").eqNullSafe(F.col("_key")))
    met = met.groupBy("_key").agg(F.first("_row").alias("_row")).select("_row")
    return met.union(rows.where(~copied).select("_row")).select("_row.*").select(*columns)
