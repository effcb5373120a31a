"""Stand-in inputs derived from the given tables, always over whole tables.

Each has a Spark form and the SQL of the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.plans.registry import table

SCORED_PAIRS_SQL = """
SELECT doc_id AS pair_id, quality AS label,
       CAST(CAST((doc_id * 7919 + 13) % 41 AS DOUBLE) / 100 + 0.4 * quality AS DOUBLE) AS score
FROM labels"""

REQUEST_EVENTS_SQL = """
SELECT event_id, ts,
       CASE WHEN user_id % 2 = 0 THEN 'bi-encoder' ELSE 'cross-encoder' END AS endpoint,
       CASE WHEN user_id % 2 = 0 THEN (CASE WHEN event_id % 3 = 0 THEN 'batch_embed' ELSE 'embed' END)
            ELSE (CASE WHEN event_id % 3 = 0 THEN 'score_pair' ELSE 'rerank' END) END AS action,
       CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
       value / CAST(50 AS DOUBLE) AS duration_s,
       value / CAST(100 AS DOUBLE) AS inference_s,
       CAST(1 + event_id % 100 AS INT) AS batch_size,
       CASE WHEN event_id % 997 = 0 THEN 512 ELSE 768 END AS dimension,
       value / CAST(500 AS DOUBLE) AS score,
       value / CAST(1000000 AS DOUBLE) AS cost,
       concat('w', CAST(user_id % 20 AS BIGINT)) AS worker_id
FROM events"""

# Each request's batch of two scores, as columns s1 and s2 for SQL.
SCORED_EVENTS_SQL = f"SELECT *, score AS s1, score + CAST(event_id % 5 AS DOUBLE) / 10 - CAST(0.2 AS DOUBLE) AS s2 FROM ({REQUEST_EVENTS_SQL})"

TRAIN_SQL = """
SELECT u.conv_id * 1000 + u.turn AS qid, u.text AS question, a.conv_id * 1000 + a.turn AS cid, a.text AS reply
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'"""

EPOCH_LOG_SQL = """
SELECT CAST(user_id % 10 AS BIGINT) AS run_id, CAST(day(ts) AS INT) AS epoch, avg(value) AS val_loss
FROM events GROUP BY 1, 2"""

RUN_METRICS_SQL = """
SELECT event_type AS model, CAST(CASE WHEN event_type = 'view' AND user_id % 3 = 1 THEN 12 ELSE user_id % 3 + 9 END AS INT) AS version,
       concat('m@', CAST(event_id % 4 AS BIGINT)) AS metric, avg(value) AS value
FROM events GROUP BY 1, 2, 3"""


def scored_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(SCORED_PAIRS_SQL.replace("FROM labels", "FROM {labels}"), labels=table(spark, sf, "labels"))


def as_requests(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Request events of an events table or stream."""
    return spark.sql(REQUEST_EVENTS_SQL.replace("FROM events", "FROM {events}"), events=events)


def request_events(spark: SparkSession, sf: str) -> DataFrame:
    return as_requests(spark, table(spark, sf, "events"))


def with_scores(events: DataFrame) -> DataFrame:
    """Request events, table or stream, with a batch of two scores each instead of one."""
    second = F.col("score") + (F.col("event_id") % 5).cast("double") / 10 - F.lit(0.2)
    return events.withColumn("scores", F.array("score", second)).drop("score")


def scored_events(spark: SparkSession, sf: str) -> DataFrame:
    return with_scores(request_events(spark, sf))


def train_pairs(spark: SparkSession, sf: str) -> DataFrame:
    sql = TRAIN_SQL.replace("conversations", "{conversations}")
    return spark.sql(sql, conversations=table(spark, sf, "conversations"))


def epoch_log(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(EPOCH_LOG_SQL.replace("FROM events", "FROM {events}"), events=table(spark, sf, "events"))


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(RUN_METRICS_SQL.replace("FROM events", "FROM {events}"), events=table(spark, sf, "events"))


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").withColumnRenamed("doc_id", "cid")


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings")


# Vectors as they were served: one every two minutes.
SERVED_VECTORS_SQL = "SELECT *, TIMESTAMP '2024-01-01 00:00:00' + vec_id * INTERVAL 2 MINUTE AS ts FROM embeddings"


def served_vectors(vectors: DataFrame) -> DataFrame:
    """The same of a table or stream of vectors."""
    return vectors.withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + F.col("vec_id") * 120))


def token_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector as a token of the text named by its label."""
    return vectors(spark, sf).select(
        F.col("label").cast("bigint").alias("doc_id"),
        F.col("vec_id").cast("int").alias("pos"),
        F.when(F.col("vec_id") % 3 == 0, 0).otherwise(1).alias("mask"),
        F.col("embedding").alias("vec"),
    )
