"""Writers. Parquet is the hand-over between stages; CSV and JSON are exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.operators.ranking_metrics import ranked_lists


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_splits(df: DataFrame, path: str) -> None:
    """One folder per split, so a reader of one split opens only its files."""
    write_table(df, path, "split")


def export_csv(df: DataFrame, path: str) -> None:
    """CSV export; lists and maps become JSON text, white space around a text stays."""
    as_is = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    flat = [
        F.to_json(c).alias(c) if kind.startswith(("array", "map", "struct")) else F.col(c) for c, kind in df.dtypes
    ]
    df.select(*flat).write.mode("overwrite").options(**as_is).csv(path)


def write_embeddings(vectors: DataFrame, path: str, **source: str | int) -> None:
    """Vectors and a one-row table: count, dimension, origin, time.

    The vectors are written once; the counts are read from what was written.
    """
    vectors.write.mode("overwrite").parquet(f"{path}/vectors")
    written = vectors.sparkSession.read.parquet(f"{path}/vectors")
    metadata = written.agg(
        F.count("*").alias("num_documents"), F.max(F.size("embedding")).alias("embedding_dim")
    ).withColumns({**{k: F.lit(v) for k, v in source.items()}, "created_at": F.current_timestamp()})
    metadata.write.mode("overwrite").parquet(f"{path}/metadata")


def write_metrics(metrics: DataFrame, path: str) -> None:
    """(metric, value) rows as one JSON object."""
    packed = metrics.agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m"))
    packed.select(F.to_json("m").alias("value")).write.mode("overwrite").text(path)


def read_metrics(spark, path: str) -> DataFrame:
    parsed = spark.read.text(path).select(F.from_json("value", "map<string,double>").alias("m"))
    return parsed.select(F.explode("m").alias("metric", "value"))


def write_predictions(queries: DataFrame, ranking: DataFrame, path: str) -> None:
    """(qid, question, cid, predictions): truth next to the ranked ids."""
    lists = ranked_lists(ranking).select("qid", F.col("cids").alias("predictions"))
    queries.join(lists, "qid", "left").write.mode("overwrite").parquet(path)
