"""From raw documents to packed training sequences, in five stages.

Every stage takes all that its predecessor kept, and its decisions take effect:
documents of low quality go, repeated lines go, one document of each group of
near duplicates stays, sources are mixed to their targets (documents may be
taken several times), and what is left is packed. All stages but the last return
the columns of ``documents``; ``n_chars`` is brought up to date where texts change.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.llm import bin_packing, line_dedup, mil_quality, mixing, near_copies, simhash
from lodestream.session import checkpoint_dir

# Near duplicates have SimHash fingerprints at most two bits apart, as in op10, or have 0.8 of their
# shingles of five words in common (Jaccard).
RADIUS = 2
SHINGLE_WORDS = 5
SIMILARITY = 0.8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.3 or more. It is fitted on the labelled
    documents of the table, so the stage's input is scored by the same model as op7."""
    return mil_quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines at least 0.8 similar to an earlier one go; a document may become empty."""
    kept = line_dedup.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return kept
    n_chars = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", n_chars)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id.

    Fingerprints link documents as in op10; an exact join links the similar ones that
    fingerprints leave apart, and a group holds all that either connects.
    Documents that lost all their lines are duplicates of each other.
    """
    marked = simhash.with_fingerprint(docs, name="_fingerprint")
    return near_copies.one_per_group(marked, SHINGLE_WORDS, SIMILARITY, "_fingerprint", RADIUS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece with its sequence and place; a document taken twice has its pieces twice."""
    return bin_packing.pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("dedup_lines", dedup_lines),
    ("dedup_documents", dedup_documents),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

# SQL cannot express the classifier, the shingles or the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
