"""Checked queries: tables written and read again through the readers and writers."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lodestream.operators import clean
from lodestream.plans.registry import query, table
from lodestream.session import checkpoint_dir
from lodestream.sources import readers, writers


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("csv_corpus_round_trip", "SELECT doc_id AS cid, text FROM documents WHERE trim(text) <> ''")
def csv_corpus_round_trip(spark, sf):
    """Texts with quotes and line breaks through CSV, read by column name and cleaned."""
    path = _folder(spark, "corpus-csv")
    writers.export_csv(table(spark, sf, "documents").select("text", F.col("doc_id").alias("cid"), "lang"), path)
    return clean.clean_corpus(readers.raw_corpus(spark, path))


@query(
    "csv_train_round_trip",
    """
    SELECT conv_id * 1000 + turn AS qid, text AS question, unnest([conv_id, conv_id + turn]) AS cid
    FROM conversations WHERE trim(text) <> ''
    """,
)
def csv_train_round_trip(spark, sf):
    """Training rows whose lists are literals in a CSV file."""
    path = _folder(spark, "train-csv")
    rows = table(spark, sf, "conversations").where(F.trim("text") != "")
    writers.export_csv(
        rows.select(
            F.array("role").alias("context"), F.array("conv_id", F.col("conv_id") + F.col("turn")).alias("cid"),
            (F.col("conv_id") * 1000 + F.col("turn")).alias("qid"), F.col("text").alias("question"),
        ),
        path,
    )
    read = clean.clean_train(readers.raw_train(spark, path))
    return read.select("qid", "question", F.explode("cid").alias("cid"))


@query(
    "embedding_store",
    """
    SELECT count(*) AS num_documents, max(len(embedding))::INT AS embedding_dim, 'hashed' AS model_name,
           count(*) AS "rows", count(DISTINCT vec_id) AS ids FROM embeddings
    """,
)
def embedding_store(spark, sf):
    """Vectors and their metadata, written once and counted from the files."""
    path = _folder(spark, "vectors")
    writers.write_embeddings(table(spark, sf, "embeddings").select(F.col("vec_id").alias("cid"), "embedding"), path, model_name="hashed")
    vectors, metadata = readers.read_embeddings(spark, path)
    report = readers.file_report(vectors).select("rows")
    ids = vectors.agg(F.count_distinct("cid").alias("ids"))
    # One row each.
    one = metadata.select("num_documents", "embedding_dim", "model_name", F.lit(1).alias("k"))
    return one.join(report.withColumn("k", F.lit(1)), "k").join(ids.withColumn("k", F.lit(1)), "k").drop("k")


@query(
    "split_store",
    """
    SELECT source AS split, doc_id FROM documents WHERE source = (SELECT min(source) FROM documents)
    """,
)
def split_store(spark, sf):
    """A folder per split; the reader of one opens no other."""
    path = _folder(spark, "splits")
    docs = table(spark, sf, "documents")
    first = docs.agg(F.min("source")).first()[0]
    writers.write_splits(docs.select("doc_id", F.col("source").alias("split")), path)
    return readers.read_split(spark, path, first).select("split", "doc_id")


@query(
    "matching_files",
    "SELECT source AS part, count(*) AS n FROM documents GROUP BY source",
)
def matching_files(spark, sf):
    """All files below a folder that match a pattern; tables that are missing are left out."""
    path = _folder(spark, "parts")
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("part"))
    writers.write_table(docs.where("doc_id % 2 = 0"), f"{path}/even")
    writers.write_table(docs.where("doc_id % 2 <> 0"), f"{path}/odd")
    found = readers.read_optional(spark, {"even": f"{path}/even", "gone": f"{path}/gone"})
    assert list(found) == ["even"]
    return readers.read_matching(spark, path, "*.parquet", "parquet").groupBy("part").agg(F.count("*").alias("n"))
