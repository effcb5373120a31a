"""URL verdicts from listed hosts and paths, by a cascade of Bloom filters.

Level 0 encodes the listed keys. Keys of the corpus that pass it without being
listed are encoded by level 1, listed keys that pass that by level 2, and so on
until a level has no false positive among all keys of the corpus. A key is listed
if the number of levels it passes before the first refusal is odd, which is exact
for every key the corpus holds. Urls are only hashed and looked up: they are not
joined with the list. The filters' size follows the list; where it passes a bound, the
keys are dealt into shards by hash and the corpus is looked up shard by shard, so
that never more than one shard is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.llm.shared import cut

# Bits of one shard's filters at most (64 MB), about 2^25 listed keys.
SHARD_BITS = 1 << 29
# Each level halves what is left; more than this many only if 128-bit hashes collide.
MAX_LEVELS = 128

RULE_SCHEMA = "host string, path string, verdict string"
# Fixed values of the registered query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- filters ------------------------------------------------------------------


def _mixed(values: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def bit_places(a: np.ndarray, b: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """(keys, hashes) bit numbers of keys given by two 64-bit hashes, other ones on every level."""
    with np.errstate(over="ignore"):
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        first, step = _mixed(a.view(np.uint64) ^ salt), _mixed(b.view(np.uint64) + salt) | np.uint64(1)
        return (first[:, None] + step[:, None] * np.arange(hashes, dtype=np.uint64)) % np.uint64(bits)


@dataclass
class Level:
    number: int
    bits: int
    hashes: int
    words: np.ndarray

    def passes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = bit_places(a, b, self.number, self.bits, self.hashes)
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def listed(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the keys are listed: exact for the keys the cascade was built over."""
    depth, left = np.zeros(len(a), np.int64), np.arange(len(a))
    for level in levels:
        left = left[level.passes(a[left], b[left])]
        depth[left] += 1
    return depth % 2 == 1


def hashed(key: Column) -> list[Column]:
    """The two hashes of a key; equal keys only are taken as equal (128 bits)."""
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit("second"), key).alias("b")]


def _level(keys: DataFrame, number: int, size: int, rate: float) -> Level:
    """The filter of ``size`` keys (a, b) that lets others pass at ``rate``."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(64, math.ceil(size * hashes / math.log(2)))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in (0, 1))
            at = bit_places(a, b, number, bits, hashes).ravel()
            word, inverse = np.unique(at >> np.uint64(6), return_inverse=True)
            held = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(held, inverse, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(held.view(np.int64))], names=["word", "held"])

    # At most bits / 64 numbers come back, which is bounded by the shard's size.
    table = keys.select("a", "b").mapInArrow(words, "word bigint, held bigint").groupBy("word").agg(F.bit_or("held").alias("held")).toArrow()
    out = np.zeros((bits + 63) // 64, np.uint64)
    out[table.column("word").to_numpy()] = table.column("held").to_numpy().view(np.uint64)
    return Level(number, bits, hashes, out)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    """Rows (key, a, b) that a level lets pass."""
    held = keys.sparkSession.sparkContext.broadcast(level)

    @F.pandas_udf("boolean")
    def passes(a, b):
        import pandas as pd

        return pd.Series(held.value.passes(a.to_numpy(), b.to_numpy()))

    return keys.where(passes("a", "b"))


def build(list_keys: DataFrame, corpus_keys: DataFrame, universe: int) -> list[Level]:
    """Cascade of the distinct keys ``list_keys`` (key, a, b) over ``corpus_keys`` (key, a, b, repeats allowed).

    ``universe`` is about how many different keys the corpus has; it only sets
    the size of level 0, which leaves about as many false positives as there are
    listed keys. Only keys that pass level 0 are shuffled.
    """
    size = list_keys.count()
    if not size:
        return []
    rate = min(0.5, size / (math.sqrt(2) * max(1, universe)))
    levels = [_level(list_keys, 0, size, rate)]
    passed = _passing(corpus_keys.select("key", "a", "b"), levels[0]).distinct().withColumn("member", F.lit(False))
    # One row a key; what is listed is told apart by grouping.
    both = passed.unionByName(list_keys.select("key", "a", "b").withColumn("member", F.lit(True)))
    told = both.groupBy("key", "a", "b").agg(F.bool_or("member").alias("member"))
    wrong, right = cut(told.where(~F.col("member")).drop("member")), list_keys.select("key", "a", "b")
    while (size := wrong.count()) > 0:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("keys of the corpus cannot be told from listed ones by their hashes")
        levels.append(_level(wrong, len(levels), size, 0.5))
        wrong, right = cut(_passing(right, levels[-1])), wrong
    return levels


# --- urls and rules ------------------------------------------------------------


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without ``://``."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def _shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """(labels of the host, length of the path) of the rules: a url has one key per shape.

    As many as there are combinations of label counts and path lengths, however
    many rules there are.
    """
    rows = rules.select(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length")).distinct().collect()
    return sorted((r["labels"], r["length"]) for r in rows)


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys under which a url would be listed, the longest first."""
    labels, count = F.split(host, r"\."), F.size(F.split(host, r"\."))
    keys = [
        F.when(
            (count >= n) & (F.length(path) >= m),
            F.concat(F.array_join(F.slice(labels, F.greatest(count - n + 1, F.lit(1)), F.lit(n)), "."), F.substring(path, 1, m)),
        )
        for n, m in shapes
    ]
    made = F.array_distinct(F.filter(F.array(*keys), lambda k: k.isNotNull()))
    by_length = F.array_sort(F.transform(made, lambda k: F.struct((-F.length(k)).alias("l"), k.alias("k"))))
    return F.transform(by_length, lambda s: s["k"])


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow", shard_bits: int = SHARD_BITS) -> DataFrame:
    """Every row of ``pages`` as ``_row`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has host (lower case), path and verdict (``allow`` or ``block``). A rule
    fits its host and all subdomains if the url's path starts with the rule's; the
    longest wins, block before allow among equal rules. A url whose keys are not listed has a null
    rule and the verdict ``otherwise``. Null urls and urls without ``://`` have an empty
    host and path. A null path of a rule is empty; rules without a host or with
    another verdict fit nothing; repeated rules count once. Repeated rows stay repeated.
    """
    known = rules.select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict").where(
        F.col("host").isNotNull() & F.col("verdict").isin("allow", "block")
    )
    shapes = _shapes(known)
    rows = pages.select(F.struct("*").alias("_row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    found = rows.withColumn("_found", F.lit(None).cast("struct<l: int, blocks: int, k: string>"))
    if shapes:
        own = known.select(F.concat("host", "path").alias("key"), "verdict").distinct()
        listed_keys = cut(own.select("key", *hashed(F.col("key")), "verdict"))
        keyed = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
        universe = keyed.select(F.explode(candidate_keys(F.col("host"), F.col("path"), shapes)).alias("key")).select("key", *hashed(F.col("key")))
        distinct = universe.agg(F.approx_count_distinct("key")).first()[0]
        size = listed_keys.count()
        # Level 0 takes 1.44 bits a key per halving; the levels after it about four more.
        per_key = 1.45 * (6 + math.log2(1 + distinct / size)) if size else 1
        shards = max(1, math.ceil(size * per_key / shard_bits))
        for shard in range(shards):
            mine = F.pmod(F.col("b"), F.lit(shards)) == shard
            cascades = {
                verdict: build(listed_keys.where(mine & (F.col("verdict") == verdict)), universe.where(mine), max(1, distinct // shards))
                for verdict in ("allow", "block")
            }
            found = _looked_up(found, shapes, cascades, shards, shard)
            if shard + 1 < shards:
                found = cut(found)
    verdict = F.when(F.col("_found.blocks") == 1, "block").when(F.col("_found.blocks") == 0, "allow").otherwise(otherwise)
    return found.select("_row", "host", "path", F.col("_found.k").alias("rule"), verdict.alias("verdict"))


def _looked_up(rows: DataFrame, shapes: list[tuple[int, int]], cascades: dict[str, list[Level]], shards: int, shard: int) -> DataFrame:
    """The longest listed key found so far, in ``_found``."""
    held = rows.sparkSession.sparkContext.broadcast(cascades)

    @F.pandas_udf("array<int>")
    def marks(a, b):
        """Per key: 2 if blocked, 1 if allowed, 0 if not listed."""
        import pandas as pd

        sizes = a.map(len).to_numpy()
        flat = [np.concatenate([np.zeros(0, np.int64), *s]).astype(np.int64) for s in (a, b)]
        mine = flat[1] % shards == shard
        allowed, blocked = (listed(held.value[v], *flat) & mine for v in ("allow", "block"))
        return pd.Series(np.split(np.where(blocked, 2, allowed.astype(int)), np.cumsum(sizes)[:-1]) if len(sizes) else [], dtype=object)

    keys = rows.withColumn("_keys", candidate_keys(F.col("host"), F.col("path"), shapes))
    first, second = F.transform("_keys", lambda k: hashed(k)[0]), F.transform("_keys", lambda k: hashed(k)[1])
    looked = keys.withColumn("_marks", marks(first, second))
    pairs = F.zip_with("_keys", "_marks", lambda k, m: F.when(m > 0, F.struct(F.length(k).alias("l"), (m - 1).alias("blocks"), k.alias("k"))))
    return looked.withColumn("_found", F.array_max(F.concat(F.array("_found"), pairs))).drop("_keys", "_marks")
