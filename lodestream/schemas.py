"""Fixed schemas (DDL), so that lists and ids survive every hop without re-parsing."""

RAW_CORPUS = "cid STRING, text STRING"
RAW_TRAIN = "question STRING, context STRING, cid STRING, qid BIGINT"
CORPUS = "cid BIGINT, text STRING"
TRAIN = "question STRING, context ARRAY<STRING>, cid ARRAY<BIGINT>, qid BIGINT"
MINED_PAIRS = "query STRING, positive_cid BIGINT, negative_cid BIGINT, label INT"
EMBEDDINGS = "cid BIGINT, text STRING, embedding ARRAY<FLOAT>"
RERANK_REQUEST = (
    "request_id BIGINT, action STRING, query STRING, document STRING, "
    "documents ARRAY<STRUCT<id: STRING, text: STRING, metadata: MAP<STRING, STRING>>>, top_n INT"
)
EMBED_REQUEST = "request_id BIGINT, action STRING, text STRING, texts ARRAY<STRING>"
REQUEST_EVENT = (
    "event_id BIGINT, ts TIMESTAMP, endpoint STRING, action STRING, status STRING, "
    "duration_s DOUBLE, inference_s DOUBLE, batch_size INT, dimension INT, "
    "scores ARRAY<DOUBLE>, cost DOUBLE, worker_id STRING"
)
LOG_LINE = "ts TIMESTAMP, logger STRING, level STRING, message STRING"
ALERT = (
    "alertname STRING, severity STRING, category STRING, endpoint STRING, status STRING, "
    "startsAt STRING, annotations MAP<STRING, STRING>"
)
RUN_METRIC = "model STRING, version INT, run_id STRING, step BIGINT, metric STRING, value DOUBLE"
