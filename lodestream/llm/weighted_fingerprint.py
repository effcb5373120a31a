"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words, weighted by their counts. For each of the
``samples`` draws, every term gets two Gamma(2, 1) values r, c and a uniform b
from hashes of the term; with t = floor(ln w / r + b) the term's value is
ln c - r (t - b) - r, and the smallest value's (term, t) is the sample. Two texts
agree in a sample with a probability equal to the generalised Jaccard similarity
of their weights, sum of minima over sum of maxima.

Only built-in functions are used. Texts are shuffled once, by a hash of id and text,
whatever the ids are; counting terms and sampling stay where a text is. Of the next
document only the head that is needed is moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.shared import cut, positions, present, row_key, whole

SAMPLES = 32
_GAP = r"[\x20\x09-\x0D]+"
_LOW = (1 << 32) - 1


def sample_value(term: Column, log_weight: Column, k: int) -> Column:
    """The k-th value of a weighted term with its (term, t) below it, as one BIGINT.

    The upper half orders by value, the lower half identifies the sample.
    """
    first, second = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))

    def uniform(bits: Column, width: int) -> Column:
        return (bits.cast("double") + 0.5) / float(1 << width)

    mask = (1 << 21) - 1
    r = -F.ln(uniform(first.bitwiseAND(F.lit(mask)), 21) * uniform(F.shiftrightunsigned(first, 21).bitwiseAND(F.lit(mask)), 21))
    b = uniform(F.shiftrightunsigned(first, 42), 22)
    log_c = F.ln(-F.ln(uniform(second.bitwiseAND(F.lit(_LOW)), 32) * uniform(F.shiftrightunsigned(second, 32), 32)))
    t = F.floor(log_weight / r + b)
    value = F.least(F.greatest(log_c - r * (t - b + 1.0), F.lit(-127.0)), F.lit(127.0))
    upper = F.shiftleft(F.floor((value + 128.0) * float(1 << 23)).cast("bigint"), 32)
    return upper.bitwiseOR(second.bitwiseXOR(t * 40503).bitwiseAND(F.lit(_LOW)))


def order(docs: DataFrame) -> DataFrame:
    """(_key, n, _next, _before, _quarter): per distinct row (id and text) how often it
    occurs, the rows after and before it, and a quarter of the length of the latter.

    Rows are ordered by doc_id (null first), those that share an id by text; after the
    last comes the first. Texts are ordered only where an id has several.
    """
    own = docs.select(row_key().alias("_key"), whole().alias("text"))
    several = own.select("_key").distinct().groupBy(F.col("_key.id").alias("_id")).agg(F.count("*").alias("n")).where("n > 1")
    own = own.withColumn("_id", F.col("_key.id"))
    tie = F.when(present(several, "_id"), F.col("text"))
    keys = own.groupBy("_key", "_id").agg(F.min(tie).alias("_tie"), F.count("*").alias("n"), F.floor(F.max(F.length("text")) / 4).cast("int").alias("_q"))
    ranked = positions(keys.withColumn("_all", F.lit(0)), ["_all"], ["_id", "_tie"])
    ranked = cut(ranked.select("_key", "n", "_q", "_pos"))
    count = max(1, ranked.count())
    after = ranked.select(F.col("_key").alias("_next"), F.pmod(F.col("_pos") - 1, F.lit(count)).alias("_pos"))
    before = ranked.select(F.col("_key").alias("_before"), F.col("_q").alias("_quarter"), F.pmod(F.col("_pos") + 1, F.lit(count)).alias("_pos"))
    return cut(ranked.join(after, "_pos").join(before, "_pos").select("_key", "n", "_next", "_before", "_quarter"))


def neighbours(docs: DataFrame, ordered: DataFrame) -> DataFrame:
    """(_key, _copy, text, next): each distinct row with the start of the next document.

    Rows that occur several times follow each other: ``_copy`` is 0 for the last of
    them, and 1 stands for the others, which are followed by themselves.
    """
    texts = docs.select(row_key().alias("_key"), whole().alias("text")).groupBy("_key").agg(F.first("text").alias("text"))
    heads = texts.join(ordered.select("_key", "_before", "_quarter"), "_key").select(F.col("_before").alias("_key"), F.expr("left(text, _quarter)").alias("_head"))
    met = texts.join(ordered.select("_key", "n"), "_key").join(heads, "_key")
    last = F.struct(F.lit(0).alias("copy"), F.col("_head").alias("next"))
    other = F.struct(F.lit(1).alias("copy"), F.col("text").alias("next"))
    return met.select("_key", "text", F.explode(F.when(F.col("n") > 1, F.array(last, other)).otherwise(F.array(last))).alias("_c")).select("_key", F.col("_c.copy").alias("_copy"), "text", F.col("_c.next").alias("next"))


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    The edited text has the last quarter of the code points (rounded down)
    replaced by as many from the start of the next document, or all it has. Null
    texts count as empty. A text without words has the fingerprint of all ones; two
    such texts are alike. Rows that share an id are told apart by their texts;
    equal rows follow each other.
    """
    ordered = order(docs)
    placed = neighbours(docs, ordered)
    n = F.length("text")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - CAST(floor(length(text) / 4) AS INT))"), F.expr("left(next, CAST(floor(length(text) / 4) AS INT))"))
    placed = placed.select("_key", "_copy", n.cast("bigint").alias("n_chars"), "text", edited.alias("edited"), (n - tail).alias("_kept"))
    # Words before the cut count for both texts; the word at the cut is taken apart.
    common = F.regexp_replace(F.expr("left(text, _kept)"), r"[^\x20\x09-\x0D]+\z", "")
    parts = placed.withColumn("_common", common).withColumn("_len", F.length("_common"))
    row = ["_key", "_copy"]
    parts = parts.select(
        *row,
        F.explode(F.array(
            F.struct(F.col("_common").alias("part"), F.lit(1).alias("a"), F.lit(1).alias("b")),
            F.struct(F.expr("substring(text, _len + 1)").alias("part"), F.lit(1).alias("a"), F.lit(0).alias("b")),
            F.struct(F.expr("substring(edited, _len + 1)").alias("part"), F.lit(0).alias("a"), F.lit(1).alias("b")),
        )).alias("p"),
    )
    words = parts.select(*row, F.col("p.a").alias("a"), F.col("p.b").alias("b"), F.explode(F.split("p.part", _GAP)).alias("word"))
    terms = words.where("word <> ''").groupBy(*row, F.xxhash64("word").alias("term")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # One row if both texts weigh the term alike (side 2), else one per text that has it.
    sides = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.lit(2).alias("side"), F.col("a").alias("w")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("w")), F.struct(F.lit(1).alias("side"), F.col("b").alias("w")))
    )
    weighed = terms.select(*row, "term", F.explode(sides).alias("s")).where("s.w > 0")
    weighed = weighed.select(*row, "term", F.col("s.side").alias("side"), F.ln(F.col("s.w").cast("double")).alias("lw"))
    drawn = weighed.groupBy(*row, "side").agg(*[F.min(sample_value(F.col("term"), F.col("lw"), k)).alias(f"m{k}") for k in range(samples)])
    merged = drawn.groupBy(*row).agg(
        *[F.min(F.when(F.col("side") != 1, F.col(f"m{k}"))).alias(f"x{k}") for k in range(samples)],
        *[F.min(F.when(F.col("side") != 0, F.col(f"m{k}"))).alias(f"y{k}") for k in range(samples)],
    )

    def packed(letter: str) -> Column:
        return F.array(*[F.coalesce(F.col(f"{letter}{k}"), F.lit(_LOW)).bitwiseAND(F.lit(_LOW)) for k in range(samples)])

    prints = merged.select(*row, packed("x").alias("_x"), packed("y").alias("_y"))
    blank = F.array_repeat(F.lit(_LOW), samples)
    facts = placed.select(*row, "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    rows = cut(facts.join(prints, row, "left").withColumns({"_x": F.coalesce("_x", blank), "_y": F.coalesce("_y", blank)}))
    following = ordered.select(F.col("_next").alias("_key"), F.col("_key").alias("_to")).join(rows.where("_copy = 0").select("_key", F.col("_x").alias("_next")), "_key")
    rows = rows.join(ordered.select("_key", "n"), "_key").join(following.select(F.col("_to").alias("_key"), "_next"), "_key")
    rows = rows.withColumn("_next", F.when(F.col("_copy") == 1, F.col("_x")).otherwise(F.col("_next")))
    times = F.when(F.col("_copy") == 1, F.col("n") - 1).otherwise(F.lit(1).cast("bigint"))
    rows = rows.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("bigint"), times))).withColumn("doc_id", F.col("_key.id"))

    def text(column: str) -> Column:
        return F.lower(F.array_join(F.transform(column, lambda v: F.lpad(F.hex(v), 8, "0")), ""))

    return rows.select(
        "doc_id", "n_chars", "edited_sha256", text("_x").alias("fingerprint"), text("_y").alias("edited_fingerprint"),
        likeness(F.col("_x"), F.col("_y")).alias("near_edited"), likeness(F.col("_x"), F.col("_next")).alias("near_next"),
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two fingerprints: estimates generalised Jaccard."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.size(a)
