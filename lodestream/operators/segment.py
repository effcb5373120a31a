"""Joining multi-word units with ``_``, learned from the corpus itself.

Pass 1 counts adjacent word pairs; words follow from the pairs' counts. A pair is a unit when
``(n_ab - discount) * N / (n_a * n_b)`` exceeds a threshold. Pass 2 rewrites
every text greedily from the left. While the units fit a measured bound, every task holds
them and texts are rewritten where they stand; beyond it, every task holds a filter of fixed size
and only pairs that pass it travel to a semi-join with the units and back to their text. Both ways
look a pair up once per word. Units are stored before they are read more than once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Collection

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.functions.text import tokens
from lodestream.session import stored

# Units a task may hold, and their bytes; 64-bit words of the filter that stands for more of them.
HELD_UNITS, HELD_BYTES, FILTER_WORDS = 1_000_000, 1 << 26, 1 << 22
_WHITE = re.compile(r"[ \t\n\x0b\f\r]+")


def learn_units(
    corpus: DataFrame, text: str = "text", min_count: int = 5, discount: float = 5.0, threshold: float = 10.0
) -> DataFrame:
    """(pair, first, second, n, score) of every word pair that forms a unit."""
    words = corpus.select(tokens(F.col(text)).alias("words"))
    # Every word is the first of one pair, the last word of a text of a pair with ''. Nothing is
    # null, so no filter is pushed below the counting and its shuffle serves all three uses.
    following = F.concat(F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))), F.array(F.lit("")))
    zipped = words.where(F.size("words") > 0).select(F.inline(F.arrays_zip(F.col("words").alias("first"), following.alias("second"))))
    sure = zipped.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("first", "second")])
    counted = sure.groupBy("first", "second").agg(F.count("*").alias("n"))
    single = counted.groupBy(F.col("first").alias("word")).agg(F.sum("n").alias("n"))
    total = words.agg(F.sum(F.size("words")).alias("total"))
    pair = counted.where(F.col("n") >= min_count).withColumn("pair", F.concat_ws(" ", "first", "second"))
    scored = (
        pair.join(single.select(F.col("word").alias("first"), F.col("n").alias("n_first")), "first")
        .join(single.select(F.col("word").alias("second"), F.col("n").alias("n_second")), "second")
        .withColumn("score", (F.col("n") - discount) * total.scalar() / (F.col("n_first") * F.col("n_second")))
    )
    return scored.where(F.col("score") > threshold).select("pair", "first", "second", "n", "score")


def _words(text: str | None) -> list[str]:
    return [w for w in _WHITE.split(text or "") if w]


def joined(text: str | None, units: Collection[str]) -> str:
    """The words of a text with single spaces, pairs listed in ``units`` joined by ``_``.

    From the left, a word joins one neighbour at most.
    """
    words = _words(text)
    free = 0
    for i, pair in enumerate(map(" ".join, zip(words, words[1:]))):
        if pair in units and i >= free:
            words[i], words[i + 1] = f"{words[i]}_{words[i + 1]}", ""
            free = i + 2
    return " ".join(filter(None, words)) if free else " ".join(words)


def _held(units: DataFrame, most: int) -> frozenset[str] | None:
    """The units, if there are no more than the bound."""
    size = units.agg(F.count("*").alias("n"), F.sum(F.octet_length("pair")).alias("bytes")).first()
    if size["n"] > most or (size["bytes"] or 0) > HELD_BYTES:
        return None
    return frozenset(units.toArrow().column(0).to_pylist())


def _filter(units: DataFrame) -> np.ndarray:
    """Two bits per unit in one of ``FILTER_WORDS`` words, all taken from XXH64 (seed 42) of the pair."""
    h = F.xxhash64("pair")
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, at).bitwiseAND(F.lit(63)).cast("int"))
    marked = units.select(h.bitwiseAND(F.lit(FILTER_WORDS - 1)).cast("int").alias("w"), bit(50).bitwiseOR(bit(57)).alias("bits"))
    rows = marked.groupBy("w").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(FILTER_WORDS, np.uint64)
    table[rows.column("w").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return table


def _passing(texts: Collection[str | None], table: np.ndarray) -> list[str]:
    """The different adjacent pairs of some texts that may be units."""
    pairs = list({pair for words in map(_words, texts) for pair in map(" ".join, zip(words, words[1:]))})
    h = np.fromiter((xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass"), 42) for p in pairs), np.uint64, len(pairs))
    six, one = np.uint64(63), np.uint64(1)
    bits = (one << ((h >> np.uint64(50)) & six)) | (one << ((h >> np.uint64(57)) & six))
    return [pairs[i] for i in np.flatnonzero(table[(h & np.uint64(len(table) - 1)).astype(np.int64)] & bits == bits)]


def _with_own_units(docs: DataFrame, texts: Column, units: DataFrame) -> DataFrame:
    """``docs`` with ``_units``, the units found in the array ``texts``, null if there are none.

    Rows are told apart by a hash of their texts. Rows that share it get each other's
    units, which are units all the same; so ``docs`` needs no key.
    """
    shared: Broadcast = docs.sparkSession.sparkContext.broadcast(_filter(units))

    @F.pandas_udf("array<string>")
    def candidates(lists: pd.Series) -> pd.Series:
        return lists.map(lambda found: _passing(found, shared.value))

    hashed = F.xxhash64(texts)
    occurring = docs.select(hashed.alias("_at"), F.explode(candidates(texts)).alias("pair"))
    # A pair occurs once per row here; adaptive execution splits hot pairs.
    found = occurring.join(units, "pair", "left_semi")
    return docs.withColumn("_at", hashed).join(found.groupBy("_at").agg(F.collect_set("pair").alias("_units")), "_at", "left").drop("_at")


def _own(units: Collection[str] | None) -> frozenset[str]:
    return frozenset(units) if units is not None else frozenset()


def segment(docs: DataFrame, units: DataFrame, key: str, text: str = "text", held_units: int = HELD_UNITS) -> DataFrame:
    """Rewrite ``text`` of every row; null → '', a text without units keeps its words.

    ``units`` is looked at when this is called, and stored first. Rows are not told
    apart by ``key``; it may repeat or be null.
    """
    units = stored(units.select("pair"))
    known = _held(units, held_units)
    if known is not None:
        shared = docs.sparkSession.sparkContext.broadcast(known)

        @F.pandas_udf("string")
        def rewrite(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: joined(t, shared.value))

        return docs.withColumn(text, rewrite(F.col(text)))

    @F.pandas_udf("string")
    def rewrite_own(texts: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series([joined(t, _own(u)) for t, u in zip(texts, own)], dtype=object)

    met = _with_own_units(docs, F.array(text), units)
    return met.withColumn(text, rewrite_own(F.col(text), F.col("_units"))).select(*docs.columns)


def segment_lists(docs: DataFrame, units: DataFrame, key: str, items: str, held_units: int = HELD_UNITS) -> DataFrame:
    """The same for every element of an array column; order is kept, a null array becomes empty."""
    units = stored(units.select("pair"))
    known = _held(units, held_units)
    filled = F.coalesce(items, F.array().cast("array<string>"))
    if known is not None:
        shared = docs.sparkSession.sparkContext.broadcast(known)

        @F.pandas_udf("array<string>")
        def rewrite(lists: pd.Series) -> pd.Series:
            return lists.map(lambda texts: [joined(t, shared.value) for t in texts])

        return docs.withColumn(items, rewrite(filled)).select(*docs.columns)

    @F.pandas_udf("array<string>")
    def rewrite_own(lists: pd.Series, own: pd.Series) -> pd.Series:
        return pd.Series([[joined(t, found) for t in texts] for texts, found in zip(lists, map(_own, own))], dtype=object)

    met = _with_own_units(docs.withColumn(items, filled), F.col(items), units)
    return met.withColumn(items, rewrite_own(F.col(items), F.col("_units"))).select(*docs.columns)


def segment_with(docs: DataFrame, segmenter: Callable[[Column], Column], text: str = "text") -> DataFrame:
    """Use a caller's segmenter, e.g. a pandas UDF, instead of learned units."""
    value = F.col(text)
    return docs.withColumn(text, F.when(value.isNull(), F.lit("")).when(F.trim(value) == "", value).otherwise(segmenter(value)))
