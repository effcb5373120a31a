"""Line de-duplication by an exact set-similarity join.

A line goes if some earlier line (by document, then line number) has at least 0.8
of its words in common (Jaccard of the word sets). Tokens of a line are put in
order of rarity; similar lines must share a token among the first few (prefix
filter). A frequent token is no key by itself but with each of the tokens that may
be the next common one, so that lines do not meet for a common word. Lines that
meet must be about equally long (length filter), and a 128-bit parity of each set
rules out most other pairs, as every differing bit is a differing token. What is
left is verified on the whole sets.

Only built-in functions are used. Rarity comes from counts of all tokens in a table of
fixed size, which every task holds; it is not joined. Lines whose text occurred
before are known at once and meet nothing. In a posting list that is long all the
same, as those of large groups of near copies, a line first meets the few lines just
before it; only lines that are still undecided then meet the rest, so that a group
of near copies costs rows in proportion to its size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.shared import cut, fixed_table, present, whole, written

THRESHOLD = 0.8
# Size of the rarity table (a byte each). It is counted on every document (of so many one).
BINS = 1 << 20
COUNTED = 1
# Tokens counted more often are keys only together with a later one, up to so many tokens in a line.
RARE = 256
PAIRED = 256
# The parity of sets up to this size is folded into one number.
FOLDED = 64
# The longest posting list whose lines all meet; and how many earlier lines are met first in longer ones.
FEW = 256
BEFORE = 4
# At most this many frequent identical lines are broadcast.
FREQUENT = 10_000
_GAP = r"[\x09\x0B-\x0D]"
_ENTRY = {"d": "bigint", "l": "bigint", "n": "bigint", "q": "bigint", "r": "bigint"}
_LOW = (1 << 31) - 1


def document() -> tuple[Column, Column]:
    """(d, h): a row's document by id (null before all others), and 31 bits of its text's
    hash, which tell documents that share an id apart; equal rows count as one."""
    return F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("d"), F.xxhash64(F.col("doc_id").isNull(), whole()).bitwiseAND(F.lit(_LOW)).alias("h")


def spaced(text: Column) -> Column:
    """The text with blanks between its words, whatever white space was there; lines stay."""
    return F.when(text.rlike(_GAP), F.regexp_replace(text, _GAP, " ")).otherwise(text)


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*document(), spaced(whole()).alias("text"))


def numbered(h: Column | str, line: Column | str) -> Column:
    """A line of a document as one number: its document's hash above, its place below."""
    return F.shiftleft(h, 32).bitwiseOR(line.cast("bigint") if isinstance(line, Column) else F.col(line).cast("bigint"))


def lines(rows: DataFrame, *more: str) -> DataFrame:
    """(d, l, line), and further columns of ``rows``."""
    split = rows.select("d", "h", *more, F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return split.select("d", numbered("h", "i").alias("l"), "line", *more)


def level_of(count: Column) -> Column:
    """Levels of a token's count: its logarithm, in thirds."""
    return F.least(F.lit(126), F.floor(F.log2(count.cast("double")) * 3) + 1).cast("tinyint")


def rarity_table(docs: DataFrame) -> Column:
    """A level per bin of token hashes: how frequent its tokens are, on a log scale."""
    tokens = docs.select(F.explode(F.split(F.replace(spaced(whole()), F.lit("\n"), F.lit(" ")), " ")).alias("w")).where("w <> ''")
    counts = tokens.groupBy(F.xxhash64("w").bitwiseAND(F.lit(BINS - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    found = counts.select("bin", level_of(F.col("n")).alias("level")).toArrow()
    table = np.zeros(BINS, np.int8)
    table[found["bin"].to_numpy()] = found["level"].to_numpy()
    return fixed_table(docs.sparkSession, table)


def token_sets(found: DataFrame, table: Column) -> DataFrame:
    """Add ``s``: the distinct tokens of ``line`` as numbers, rarest first.

    The upper seven bits are the token's level in the table, the rest its hash,
    so numbers order by rarity and identify the token.
    """
    blank = F.xxhash64(F.lit(""))
    hashed = F.array_remove(F.array_distinct(F.transform(F.split("line", " "), lambda w: F.xxhash64(w))), blank)

    def ranked(x: Column) -> Column:
        # Never null, so that the arrays are sorted as plain numbers.
        level = F.coalesce(F.get("_table", x.bitwiseAND(F.lit(BINS - 1)).cast("int")).cast("bigint"), F.lit(0).cast("bigint"))
        return F.shiftleft(level, 56).bitwiseOR(x.bitwiseAND(F.lit((1 << 56) - 1)))

    # Subqueries are not written inside lambdas; the two steps become one, so no row ever holds the table.
    return found.withColumn("_table", table).withColumn("s", F.sort_array(F.transform(hashed, ranked))).drop("_table")


def needed(a: Column, b: Column, threshold: float) -> Column:
    """The smallest overlap of sets of sizes a and b with that Jaccard similarity."""
    per_mille = round(threshold * 1000)
    return F.ceil((a + b) * F.lit(per_mille) / F.lit(1000 + per_mille)).cast("int")


def keys_of(s: Column, n: Column, misses: Column) -> Column:
    """Numbers of which two similar lines have one in common.

    A line lacks at most ``misses`` of its ``n`` tokens in a similar one, so their first
    common token is among its first ``misses`` + 1. If that is frequent, the key is this
    token with the second common one, before which the line may lack what is left of
    ``misses``. Long lines would have too many such pairs: frequent tokens are keys by
    themselves among them, and lines that may be similar to either kind have both.
    """
    frequent = F.lit((int(np.floor(np.log2(RARE) * 3)) + 2) << 56)

    def pairs(t: Column, i: Column) -> Column:
        return F.transform(F.slice(s, i + 2, misses - i + 1), lambda u: F.xxhash64(t, u))

    def keys(t: Column, i: Column) -> Column:
        single, long = F.array(t), F.array(F.xxhash64(t))
        either = F.when(n <= PAIRED, pairs(t, i)).when(n <= PAIRED * 5 // 4, F.concat(pairs(t, i), long)).otherwise(long)
        return F.when((t < frequent) | (n == 1), single).otherwise(either)

    return F.flatten(F.transform(F.slice(s, F.lit(1), misses + 1), keys))


def parity(s: Column, n: Column) -> tuple[Column, Column]:
    """(q, r): every token turns one of 128 bits; of small sets both halves are one, in ``q``."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def turned(tokens: Column) -> Column:
        return F.aggregate(tokens, none, lambda a, x: a.bitwiseXOR(F.call_function("shiftleft", one, x.bitwiseAND(F.lit(63)).cast("int"))))

    def half(which: int) -> Column:
        return turned(F.filter(s, lambda x: F.shiftright(x, 6).bitwiseAND(F.lit(1)) == which))

    return F.when(n <= FOLDED, turned(s)).otherwise(half(0)), F.when(n <= FOLDED, none).otherwise(half(1))


def postings(found: DataFrame, threshold: float) -> DataFrame:
    """(t, d, l, n, q, r): a row per key of each line, with the size of its set and its parity."""
    s, n = F.col("s"), F.size("s")
    misses = n - F.ceil(n * F.lit(round(threshold * 1000)) / F.lit(1000)).cast("int")
    q, r = parity(s, n)
    # The outer form, as Spark would put the plain form's test for empty arrays, which
    # holds the whole computation of ``s``, below it and compute ``s`` again for it.
    measured = found.select("d", "l", n.cast("bigint").alias("n"), q.alias("q"), r.alias("r"), keys_of(s, n, misses).alias("keys"))
    return measured.select(F.explode_outer("keys").alias("t"), *_ENTRY).where("t IS NOT NULL")


def bits_apart() -> Column:
    """Bits in which the parities of two lines differ: no more than their sets do."""
    q, r = F.col("q").bitwiseXOR(F.col("q2")), F.col("r").bitwiseXOR(F.col("r2"))
    return F.when(F.least("n", "n2") > FOLDED, F.bit_count(q) + F.bit_count(r)).otherwise(F.bit_count(q.bitwiseXOR(r)))


def may_match(threshold: float) -> Column:
    """Length and parity filters for two lines that share a key."""
    n, n2 = F.col("n"), F.col("n2")
    overlap = needed(n, n2, threshold)
    return (F.least(n, n2) >= overlap) & (bits_apart() <= n + n2 - 2 * overlap)


def renamed(columns: list[str]) -> list[Column]:
    return [F.col(c).alias(f"{c}2") for c in columns]


def removed_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(d, h, gone): per document that loses lines, their numbers from 0."""
    rows = keyed(docs)
    table = rarity_table(docs)
    this, that = ["d", "l"], ["d2", "l2"]
    earlier = (F.col("d2") < F.col("d")) | ((F.col("d2") == F.col("d")) & (F.col("l2") < F.col("l")))

    # Lines whose text occurred before.
    def texts(of: DataFrame) -> DataFrame:
        worded = lines(of).where(F.trim("line") != "")
        return worded.withColumn("k", F.xxhash64("line")).withColumn("k2", F.xxhash64(F.lit(1), "line"))

    groups = cut(texts(rows).groupBy("k", "k2").agg(F.min(F.struct(*this)).alias("first"), F.count("*").alias("n")).where("n > 1"))
    count = groups.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") > max(2, count // FREQUENT)
    frequent = groups.where(often).select("k", "k2", "first")
    copies = texts(rows).select(*this, "k", "k2").join(groups.select("k", "k2", "first", often.alias("often")), ["k", "k2"])
    copies = cut(copies.where(F.struct(*this) > F.col("first")).select(*this, "often"))
    again = copies.select(*this)

    # The other lines, each text in its first place.
    known = cut(by_document(copies.where(~F.col("often"))))
    hit = present(known, "d", "h")
    some = rows.where(hit).join(known, ["d", "h"], "left")
    fresh = F.coalesce(~F.array_contains("gone", F.col("l").bitwiseAND(F.lit(_LOW)).cast("int")), F.lit(True))
    met = lines(some, "gone").where(fresh).drop("gone").union(lines(rows.where(~hit))).where(F.trim("line") != "")
    met = met.withColumn("k", F.xxhash64("line")).withColumn("k2", F.xxhash64(F.lit(1), "line"))
    met = met.join(F.broadcast(frequent), ["k", "k2"], "left").where(F.col("first").isNull() | (F.col("first") == F.struct(*this)))
    own = postings(token_sets(met.select(*this, "line"), table), threshold)
    listed = own.withColumn("m", F.count("*").over(Window.partitionBy("t"))).where("m > 1").select("t", *_ENTRY, "m")
    fits = earlier & may_match(threshold)
    # The pairs of the shorter lists, and (without d2) the lines of longer ones: they meet the few before them.
    short = listed.where(F.col("m") <= FEW).select(F.col("t").alias("t2"), *renamed(list(_ENTRY)))
    both = listed.join(short, (F.col("t") == F.col("t2")) & fits, "left").where((F.col("m") > FEW) | F.col("d2").isNotNull())
    apart = bits_apart().alias("apart")
    kept = [F.when(F.col("m") > FEW, F.col(c)).alias(c) for c in ("t", "q", "r")]
    candidates = written(both.select(*this, *that, "n", "n2", apart, *kept))
    long = candidates.where("d2 IS NULL").select("t", *_ENTRY)
    inside = Window.partitionBy("t").orderBy(*this)
    before = [F.lag(F.struct(*[F.col(c).alias(f"{c}2") for c in _ENTRY]), k).over(inside) for k in range(1, BEFORE + 1)]
    close = long.select(*_ENTRY, F.array(*before).alias("b")).select(*_ENTRY, F.explode("b").alias("b")).where("b IS NOT NULL").select(*_ENTRY, "b.*").where(fits)
    pairs = candidates.where("d2 IS NOT NULL").select(*this, *that, "n", "n2", "apart").union(close.select(*this, *that, "n", "n2", apart))
    near = pairs.groupBy(*this, *that, "n", "n2").agg(F.count("*").alias("c"), F.min("apart").alias("apart"))
    open_keys = long.groupBy(*this).agg(F.count("*").alias("long"))
    # Long lines have a key for each common token of their prefixes, so that these count.
    by_count = F.least("n", "n2") > PAIRED * 5 // 4
    shared = F.col("c") + F.coalesce("long", F.lit(0))
    hopeful = cut(near.join(open_keys, this, "left").where(~by_count | enough(shared, threshold)).select(*this, *that, "apart"))

    # First the likeliest earlier line of each, then what is left of the candidates.
    likeliest = hopeful.groupBy(*this).agg(F.min_by(F.struct(*that), F.struct("apart", *that)).alias("y")).select(*this, "y.*")
    similar = cut(verified(rows, likeliest, table, threshold))
    rest = hopeful.select(*this, *that).join(similar, this, "left_anti")
    undecided = long.join(similar, this, "left_anti")
    far = undecided.join(long.select("t", *renamed(list(_ENTRY))), "t").where(fits).select(*this, *that)
    rest = rest.union(far).distinct().join(likeliest, [*this, *that], "left_anti")
    return by_document(again.union(similar).union(verified(rows, rest, table, threshold)))


def by_document(found: DataFrame) -> DataFrame:
    """(d, h, gone) of lines (d, l): a row per document, with their numbers from 0."""
    return found.groupBy("d", F.shiftright("l", 32).alias("h")).agg(F.collect_set(F.col("l").bitwiseAND(F.lit(_LOW)).cast("int")).alias("gone"))


def enough(shared: Column, threshold: float) -> Column:
    """Whether lines of n and n2 tokens that share so many prefix tokens can be similar.

    Tokens are ordered, so a common token outside one of the prefixes is in the rest
    of the line whose prefix ends first: the overlap is at most ``shared`` and the
    longer rest.
    """
    n, n2 = F.col("n"), F.col("n2")
    rest = F.ceil(F.greatest(n, n2) * F.lit(round(threshold * 1000)) / F.lit(1000)).cast("int") - 1
    return shared + rest >= needed(n, n2, threshold)


def sets_of(rows: DataFrame, ends: DataFrame, table: Column) -> DataFrame:
    """(d, l, s) for the lines (d, l) of ``ends``: only these lines are moved."""
    ends = cut(ends)
    found = lines(rows).where(present(ends, "d", "l")).join(ends, ["d", "l"])
    return token_sets(found.groupBy("d", "l").agg(F.min("line").alias("line")), table).select("d", "l", "s")


def verified(rows: DataFrame, pairs: DataFrame, table: Column, threshold: float) -> DataFrame:
    """The lines (d, l) of ``pairs`` whose partner (d2, l2) is similar enough."""
    pairs = cut(pairs)
    ends = pairs.select("d", "l").union(pairs.select("d2", "l2")).distinct()
    sets = cut(sets_of(rows, ends, table))
    both = pairs.join(sets, ["d", "l"]).join(sets.select(*renamed(["d", "l", "s"])), ["d2", "l2"])
    overlap = F.size(F.array_intersect("s", "s2"))
    return both.where(overlap >= needed(F.size("s"), F.size("s2"), threshold)).select("d", "l").distinct()


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one, same columns and rows.

    Lines end at ``\\n``; words are separated by ASCII white space and compared as
    they are. Lines without words are never removed. Rows equal in doc_id and text
    count as one document, a null doc_id is before all others, and of documents that
    share an id the one with the smaller text hash is first. A null text stays null.
    """
    return stripped(docs, threshold).select("_row.*").select(*docs.columns)


def stripped(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(_row, n_lines, n_removed): whole rows with their new text, and the counts."""
    gone = cut(removed_lines(docs, threshold))
    rows = docs.select(F.struct("*").alias("_row"), *document())
    hit = present(gone, "d", "h")
    every = F.split("_row.text", "\n")
    left = F.filter(every, lambda line, i: ~F.array_contains(F.col("gone"), i))
    text = F.when(F.col("gone").isNull(), F.col("_row.text")).otherwise(F.array_join(left, "\n"))
    lines_of = F.coalesce(F.size(every), F.lit(0)).alias("n_lines")
    met = rows.where(hit).join(gone, ["d", "h"], "left")
    met = met.select(F.col("_row").withField("text", text).alias("_row"), lines_of, F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"))
    # Documents that lose nothing stay where they are.
    return met.union(rows.where(~hit).select("_row", lines_of, F.lit(0).alias("n_removed")))
