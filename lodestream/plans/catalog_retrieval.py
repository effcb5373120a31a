"""Checked queries: vectors, exact top-k, ranking metrics, mining, reranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestream.functions.vector import l2_normalize
from lodestream.operators import clean, drift, losses, mining, pooling, ranking_metrics, rerank, split
from lodestream.operators.encode import AveragedWordEncoder, HashedEncoder
from lodestream.operators.pair_metrics import label_balance
from lodestream.operators.topk import exact_topk
from lodestream.plans import views
from lodestream.plans.registry import query, table
from lodestream.plans.retrieve import retrieve_and_rerank
from lodestream.session import stored

# Scores are multiples of 1e-9; a tenth of that keeps six printed digits off
# the halves, where engines round differently.
_NUDGE = 1e-10


def _six(score):
    return F.round(score + _NUDGE, 6)


# Every vector is a query against all the others.
_TOPK = """
    topk AS (SELECT * FROM (
      SELECT qid, cid, score, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, cid) AS INT) AS rank
      FROM (SELECT q.vec_id AS qid, c.vec_id AS cid,
                   round(list_dot_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 9) AS score
            FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id)) WHERE rank <= {k})
"""
_JUDGED = (
    _TOPK.format(k=100)
    + """,
    judged AS (SELECT t.*, CAST(a.label = b.label AS INT) AS rel FROM topk t
      JOIN embeddings a ON a.vec_id = qid JOIN embeddings b ON b.vec_id = cid),
    truth AS (SELECT vec_id AS qid, count(*) OVER (PARTITION BY label) - 1 AS n_truth FROM embeddings)
"""
)


def _ranking(spark, sf, k):
    vectors = views.vectors(spark, sf)
    return exact_topk(
        vectors.withColumnRenamed("vec_id", "qid"), vectors.withColumnRenamed("vec_id", "cid"), k, exclude_self=True
    )


def _judged(spark, sf, k=100):
    groups = views.vectors(spark, sf).select(F.col("vec_id").alias("id"), F.col("label").alias("grp"))
    return ranking_metrics.judge_by_group(_ranking(spark, sf, k), groups), ranking_metrics.truth_sizes_by_group(groups)


@query("topk_exact", f"WITH {_TOPK.format(k=50)} SELECT qid, cid, rank, round(score + {_NUDGE}, 6) AS score FROM topk")
def topk_exact(spark, sf):
    """J1, J5, T1, F1, W3."""
    return _ranking(spark, sf, 50).select("qid", "cid", "rank", _six(F.col("score")).alias("score"))


def _metric_sql() -> str:
    parts = []
    for k in ranking_metrics.RECALL_K:
        hit = f"CAST(coalesce(max(rel) FILTER (WHERE rank <= {k}), 0) AS DOUBLE)"
        for name in ("recall", "hit_rate"):
            parts.append((f"{name}@{k}", hit))
        parts.append((f"set_recall@{k}", f"coalesce(sum(rel) FILTER (WHERE rank <= {k}), 0) / nullif(any_value(n_truth), 0)"))
    for k in ranking_metrics.PRECISION_K:
        parts.append((f"precision@{k}", f"coalesce(sum(rel) FILTER (WHERE rank <= {k}), 0) / CAST({k} AS DOUBLE)"))
    for k in ranking_metrics.NDCG_K:
        ideal = f"list_sum(list_transform(range(1, least(any_value(n_truth), {k}) + 1), lambda r: 1 / log2(r + 1)))"
        parts.append((f"ndcg@{k}", f"coalesce(sum(rel / log2(rank + 1)) FILTER (WHERE rank <= {k}) / {ideal}, 0)"))
    parts.append(("mrr", "coalesce(1.0 / min(rank) FILTER (WHERE rel = 1), 0)"))
    parts.append(("map", "sum(rel * hits / rank) / nullif(any_value(n_truth), 0)"))
    cols = ", ".join(f'{expr} AS "{name}"' for name, expr in parts)
    union = " UNION ALL ".join(
        f"SELECT '{name}' AS metric, round(coalesce(avg(\"{name}\"), 0), 6) AS value FROM q"
        if name != "map"
        else "SELECT 'map' AS metric, round(coalesce(avg(map) FILTER (WHERE map > 0), 0), 6) AS value FROM q"
        for name, _ in parts
    )
    return f"""
    WITH {_JUDGED},
    running AS (SELECT *, sum(rel) OVER (PARTITION BY qid ORDER BY rank) AS hits FROM judged),
    q AS (SELECT qid, {cols} FROM truth LEFT JOIN running USING (qid) GROUP BY qid)
    {union}
    """


@query("retrieval_metrics", _metric_sql())
def retrieval_metrics(spark, sf):
    """Rank everything, judge by shared label, average."""
    judged, sizes = _judged(spark, sf)
    means = ranking_metrics.mean_metrics(ranking_metrics.per_query(judged, sizes, set_recall=True))
    return means.select("metric", F.round("value", 6).alias("value"))


@query(
    "reciprocal_ranks",
    f"WITH {_JUDGED} SELECT qid, round(coalesce(1.0 / min(rank) FILTER (WHERE rel = 1), 0), 6) AS rr FROM judged GROUP BY qid",
)
def reciprocal_ranks(spark, sf):
    """A4 before averaging, with the other metrics switched off."""
    judged, sizes = _judged(spark, sf)
    rows = ranking_metrics.per_query(judged, sizes, (), (), (), use_map=False)
    return rows.select("qid", F.round("mrr", 6).alias("rr"))


@query(
    "retrieval_failed_cases",
    f"""
    WITH {_JUDGED}
    SELECT qid, string_agg(cid, ',' ORDER BY rank) FILTER (WHERE rank <= 10) AS top_cids FROM judged
    GROUP BY qid HAVING coalesce(max(rel) FILTER (WHERE rank <= 3), 0) = 0
    """,
)
def retrieval_failed_cases(spark, sf):
    """T8, with a hit expected among the first 3."""
    judged, sizes = _judged(spark, sf)
    failed = ranking_metrics.failed_cases(sizes.select("qid"), judged, within=3)
    return failed.select("qid", F.array_join("top_cids", ",").alias("top_cids"))


@query(
    "rankings_sample",
    f"""
    WITH {_TOPK.format(k=10)}
    SELECT qid, string_agg(cid, ',' ORDER BY rank) AS cids, round(sum(score) + {_NUDGE}, 6) AS score_sum FROM topk
    WHERE qid IN (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 100) GROUP BY qid
    """,
)
def rankings_sample(spark, sf):
    """A report on the first 100 queries."""
    queries = views.vectors(spark, sf).select(F.col("vec_id").alias("qid"))
    rows = ranking_metrics.rankings_sample(queries, _ranking(spark, sf, 10))
    total = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x)
    return rows.select("qid", F.array_join("cids", ",").alias("cids"), _six(total).alias("score_sum"))


@query(
    "ranked_lists",
    f"WITH {_TOPK.format(k=10)} SELECT qid, string_agg(cid, ',' ORDER BY rank) AS cids FROM topk GROUP BY qid",
)
def ranked_lists(spark, sf):
    """The predictions table."""
    return ranking_metrics.ranked_lists(_ranking(spark, sf, 10)).select("qid", F.array_join("cids", ",").alias("cids"))


# Mining: the two nearest documents of a query are its known positives.
_MINED = (
    _TOPK.format(k=50)
    + """,
    positives AS (SELECT qid, list(cid ORDER BY rank) AS cids FROM topk WHERE rank <= 2 GROUP BY qid),
    negatives AS (SELECT qid, cid AS negative_cid, score, cids,
        CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, cid) AS INT) AS neg_rank
      FROM topk JOIN positives USING (qid) WHERE NOT list_contains(cids, cid) AND score >= 0.3),
    pairs AS (SELECT qid, 'q' || qid AS query, unnest(cids) AS positive_cid, CAST(NULL AS BIGINT) AS negative_cid,
                     CAST(1 AS INT) AS label FROM positives
              UNION ALL SELECT qid, 'q' || qid, cids[1], negative_cid, 0 FROM negatives WHERE neg_rank <= 10)
"""
)


def _mining_input(spark, sf):
    ranking = stored(_ranking(spark, sf, 50))
    lists = ranking_metrics.ranked_lists(ranking.where(F.col("rank") <= 2))
    queries = lists.select("qid", F.concat(F.lit("q"), F.col("qid").cast("string")).alias("question"), F.col("cids").alias("cid"))
    return queries, ranking


@query(
    "hard_negatives",
    f"WITH {_MINED} SELECT qid, negative_cid, neg_rank, round(score + {_NUDGE}, 6) AS score FROM negatives WHERE neg_rank <= 10",
)
def hard_negatives(spark, sf):
    """J2, P10, W2, T2."""
    rows = mining.hard_negatives(*_mining_input(spark, sf))
    return rows.select("qid", "negative_cid", "neg_rank", _six(F.col("score")).alias("score"))


@query("mined_pairs", f"WITH {_MINED} SELECT * FROM pairs")
def mined_pairs(spark, sf):
    """G2, U1, T2."""
    queries, ranking = _mining_input(spark, sf)
    return mining.mined_pairs(queries, mining.hard_negatives(queries, ranking))


@query(
    "mined_pairs_by_split",
    f"""
    WITH {_MINED},
    s AS (SELECT vec_id AS qid, CASE
      WHEN ('0x' || substr(md5('42:' || vec_id), 1, 8))::BIGINT < 3006477107 THEN 'train'
      WHEN ('0x' || substr(md5('43:' || vec_id), 1, 8))::BIGINT < 1431655765 THEN 'test' ELSE 'val' END AS split FROM embeddings)
    SELECT split, count(*) AS total, count(*) FILTER (WHERE label = 1) AS positive,
           count(*) FILTER (WHERE label = 0) AS negative FROM pairs JOIN s USING (qid) GROUP BY split
    """,
)
def mined_pairs_by_split(spark, sf):
    """One mining job for all splits."""
    queries, ranking = _mining_input(spark, sf)
    queries = split.hash_split(queries, "qid")
    pairs = mining.mined_pairs(queries, mining.hard_negatives(queries, ranking))
    return pairs.groupBy("split").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("label") == 1).alias("positive"),
        F.count_if(F.col("label") == 0).alias("negative"),
    )


@query(
    "label_balance",
    f"""
    WITH {_MINED} SELECT count(*) AS total, count(*) FILTER (WHERE label = 1) AS positive,
    count(*) FILTER (WHERE label = 0) AS negative FROM pairs
    """,
)
def mined_label_balance(spark, sf):
    """A17."""
    return label_balance(mined_pairs(spark, sf))


@query(
    "negative_lists",
    f"""
    WITH {_MINED}
    SELECT qid, string_agg(cid, ',' ORDER BY rank) AS negatives FROM topk JOIN positives USING (qid)
    WHERE NOT list_contains(cids, cid) GROUP BY qid
    """,
)
def negative_lists(spark, sf):
    """Array form of the positive filter."""
    queries, ranking = _mining_input(spark, sf)
    lists = ranking_metrics.ranked_lists(ranking).select("qid", F.col("cids").alias("candidates"))
    both = lists.join(queries.select("qid", F.col("cid").alias("positives")), "qid")
    return mining.negatives_as_lists(both).select("qid", F.array_join("negatives", ",").alias("negatives"))


@query(
    "candidates_without_positives",
    f"WITH {_MINED} SELECT qid, cid FROM topk JOIN positives USING (qid) WHERE NOT list_contains(cids, cid)",
)
def candidates_without_positives(spark, sf):
    """J2 as an anti-join."""
    queries, ranking = _mining_input(spark, sf)
    return mining.without_positives(ranking, queries.select("qid", F.explode("cid").alias("cid"))).select("qid", "cid")


@query(
    "doc_lookup",
    f"""
    WITH {_MINED},
    r AS (SELECT qid, label, CASE WHEN label = 1 THEN positive_cid ELSE coalesce(negative_cid, positive_cid) END AS doc_cid FROM pairs)
    SELECT qid, label, doc_cid + 7 AS doc_cid, md5(coalesce(text, '')) AS text_digest FROM r LEFT JOIN documents ON doc_id = doc_cid + 7
    """,
)
def doc_lookup(spark, sf):
    """Document of every pair; one missing from the corpus is ''."""
    # Ids are moved by seven, so that the last ones really are missing from the corpus.
    known = views.corpus(spark, sf)
    resolved = mined_pairs(spark, sf).select(
        "qid", "label", clean.resolved_document(F.col("label"), F.col("positive_cid"), F.col("negative_cid")).alias("doc_cid")
    ).withColumn("doc_cid", F.col("doc_cid") + 7)
    texted = clean.attach_text(resolved, known, "doc_cid")
    return texted.select("qid", "label", "doc_cid", F.md5("document").alias("text_digest"))


@query(
    "l2_normalize",
    """
    SELECT vec_id, CAST(i AS INT) AS dim, round(scaled[i + 1] / greatest(sqrt(list_dot_product(scaled, scaled)), 1e-12), 6) AS value
    FROM (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x * (vec_id % 7)) AS scaled FROM embeddings),
         range(0, 64) t(i)
    """,
)
def normalized_vectors(spark, sf):
    """F2; every seventh vector is zero and stays zero."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("vec_id") % 7))
    rows = views.vectors(spark, sf).select("vec_id", F.posexplode(l2_normalize(scaled)).alias("dim", "value"))
    return rows.withColumn("value", F.round("value", 6))


_TOKENS = """
    cells AS (SELECT CAST(label AS BIGINT) AS doc_id, vec_id AS pos, CAST(vec_id % 3 > 0 AS INT) AS mask,
                     CAST(i AS INT) AS dim, embedding[i + 1]::DOUBLE AS v FROM embeddings, range(0, 64) t(i))
"""


def _cells(pooled):
    rows = pooled.select("doc_id", F.posexplode("embedding").alias("dim", "value"))
    return rows.withColumn("value", F.round(F.col("value").cast("double"), 6))


@query(
    "mean_pool",
    f"WITH {_TOKENS} SELECT doc_id, dim, round(sum(v * mask) / greatest(sum(mask), 1e-9), 6) AS value FROM cells GROUP BY 1, 2",
)
def mean_pool(spark, sf):
    """A20."""
    return _cells(pooling.mean_pool(views.token_vectors(spark, sf)))


@query(
    "max_pool",
    f"WITH {_TOKENS} SELECT doc_id, dim, round(coalesce(max(v) FILTER (WHERE mask > 0), 0), 6) AS value FROM cells GROUP BY 1, 2",
)
def max_pool(spark, sf):
    """D7."""
    return _cells(pooling.max_pool(views.token_vectors(spark, sf)))


@query(
    "cls_pool",
    f"WITH {_TOKENS} SELECT doc_id, dim, round(arg_min(v, pos), 6) AS value FROM cells GROUP BY 1, 2",
)
def cls_pool(spark, sf):
    """A21."""
    return _cells(pooling.first_token_pool(views.token_vectors(spark, sf)))


_BATCHED = (
    _TOPK.format(k=1)
    + """,
    b AS (SELECT qid, cid, row_number() OVER (ORDER BY ('0x' || substr(md5('42:0:' || qid), 1, 8))::BIGINT, qid) - 1 AS pos FROM topk),
    rows_ AS (SELECT b.qid, pos, q.embedding::DOUBLE[] AS qv, c.embedding::DOUBLE[] AS pv FROM b
      JOIN embeddings q ON q.vec_id = b.qid JOIN embeddings c ON c.vec_id = b.cid)
"""
)
_LOSS = """
    scores AS (SELECT a.g, a.qid, a.qid = b.qid AS own, 20 * list_dot_product(a.qv, b.pv) AS s
      FROM grouped a JOIN grouped b ON a.g = b.g),
    per_row AS (SELECT g, qid, max(s) AS m, any_value(s) FILTER (WHERE own) AS own FROM scores GROUP BY g, qid),
    lse AS (SELECT g, p.qid, any_value(m) + ln(sum(exp(s - m))) - any_value(p.own) AS loss
      FROM scores JOIN per_row p USING (g, qid) GROUP BY g, p.qid)
"""


def _training_rows(spark, sf):
    vectors = views.vectors(spark, sf)
    pairs = _ranking(spark, sf, 1).select("qid", "cid")
    joined = pairs.join(vectors.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("query_vec")), "qid").join(
        vectors.select(F.col("vec_id").alias("cid"), F.col("embedding").alias("positive_vec")), "cid"
    )
    return joined.withColumn("row_id", F.col("qid"))


def _batched(spark, sf):
    return split.with_batches(_training_rows(spark, sf), "row_id", 64)


@query(
    "inbatch_loss",
    f"""
    WITH {_BATCHED}, grouped AS (SELECT *, CAST(floor(pos / 64) AS BIGINT) AS g FROM rows_), {_LOSS}
    SELECT g AS batch_id, count(*) AS rows, round(avg(loss), 6) AS loss FROM lse GROUP BY g
    """,
)
def inbatch_loss(spark, sf):
    """A22 over vectors and their nearest neighbours, batches of 64."""
    out = losses.inbatch_softmax(_batched(spark, sf))
    return out.withColumn("loss", F.round("loss", 6))


@query(
    "inbatch_epoch_loss",
    f"""
    WITH {_BATCHED}, grouped AS (SELECT *, CAST(floor(pos / 64) AS BIGINT) AS g FROM rows_), {_LOSS}
    SELECT round(avg(b), 6) AS loss FROM (SELECT avg(loss) AS b FROM lse GROUP BY g)
    """,
)
def inbatch_epoch_loss(spark, sf):
    """A22, mean over batches."""
    return losses.epoch_loss(losses.inbatch_softmax(_batched(spark, sf))).select(F.round("loss", 6).alias("loss"))


@query(
    "cached_inbatch_loss",
    f"""
    WITH {_BATCHED}, grouped AS (SELECT *, CAST(floor(pos / 256) AS BIGINT) AS g FROM rows_), {_LOSS}
    SELECT g AS cache_id, count(*) AS rows, CASE WHEN count(*) >= 200 THEN round(avg(loss), 6) END AS loss FROM lse GROUP BY g
    """,
)
def cached_inbatch_loss(spark, sf):
    """Caches of at least 200 rows, i.e. four batches of 64."""
    out = losses.cached_inbatch_softmax(_batched(spark, sf), cache_size=200)
    return out.withColumn("loss", F.round("loss", 6))


@query(
    "cached_unequal_loss",
    f"""
    WITH RECURSIVE {_BATCHED}, uneven AS (SELECT *, CAST(floor(sqrt(pos)) AS BIGINT) AS b FROM rows_),
    sizes AS (SELECT b, count(*) AS n FROM uneven GROUP BY b),
    walk(b, cache, held) AS (SELECT 0::BIGINT, 0::BIGINT, n FROM sizes WHERE b = 0
      UNION ALL SELECT s.b, CASE WHEN w.held >= 150 THEN cache + 1 ELSE cache END, CASE WHEN w.held >= 150 THEN s.n ELSE w.held + s.n END
      FROM walk w JOIN sizes s ON s.b = w.b + 1),
    grouped AS (SELECT uneven.*, cache AS g FROM uneven JOIN walk USING (b)), {_LOSS}
    SELECT g AS cache_id, count(*) AS rows, CASE WHEN count(*) >= 150 THEN round(avg(loss), 6) END AS loss FROM lse GROUP BY g
    """,
)
def cached_unequal_loss(spark, sf):
    """A23 with batches of 1, 3, 5, 7, … rows: caches fill by rows, not by batches."""
    placed = split.seeded_shuffle(_training_rows(spark, sf), "row_id")
    rows = placed.withColumn("batch_id", F.floor(F.sqrt("pos")).cast("bigint")).drop("pos")
    out = losses.cached_inbatch_softmax(rows, cache_size=150)
    return out.withColumn("loss", F.round("loss", 6))


@query(
    "embedding_drift",
    """
    WITH cells AS (SELECT label, vec_id, i, embedding[i + 1]::DOUBLE AS v FROM embeddings, range(0, 64) t(i)),
    base AS (SELECT i, avg(v) AS b FROM cells GROUP BY i),
    means AS (SELECT label, i, avg(v) AS m FROM cells GROUP BY label, i),
    d AS (SELECT label, 1 - sum(m * b) / (sqrt(sum(m * m)) * sqrt(sum(b * b))) AS drift FROM means JOIN base USING (i) GROUP BY label)
    SELECT label, n, round(drift, 6) AS drift, drift > 0.1 AS drifted
    FROM d JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY label) USING (label)
    """,
)
def embedding_drift(spark, sf):
    """D3: mean vector of every label against the mean of all vectors."""
    vectors = views.vectors(spark, sf)
    return drift.embedding_drift(vectors, vectors, "label").withColumn("drift", F.round("drift", 6))


def _drift_windows_sql(length: int, step: int) -> str:
    """Windows of ``length`` steps of ``step`` minutes, straight from the vectors."""
    return f"""
    SELECT * FROM (
    WITH v AS ({views.SERVED_VECTORS_SQL}),
    base AS (SELECT i, avg(embedding[i + 1]::DOUBLE) AS b FROM embeddings, range(0, 64) t(i) GROUP BY i),
    w AS (SELECT time_bucket(INTERVAL {step} MINUTE, ts) - k * INTERVAL {step} MINUTE AS window_start, vec_id, embedding FROM v, range(0, {length}) r(k)),
    means AS (SELECT window_start, i, avg(embedding[i + 1]::DOUBLE) AS m FROM w, range(0, 64) t(i) GROUP BY ALL),
    d AS (SELECT window_start, 1 - sum(m * b) / (sqrt(sum(m * m)) * sqrt(sum(b * b))) AS drift FROM means JOIN base USING (i) GROUP BY ALL)
    SELECT window_start, window_start + INTERVAL {length * step} MINUTE AS window_end, n, round(drift, 6) AS drift, drift > 0.1 AS drifted
    FROM d JOIN (SELECT window_start, count(*) AS n FROM w GROUP BY ALL) USING (window_start))
    """


@query("embedding_drift_windows", _drift_windows_sql(1, 60))
def embedding_drift_windows(spark, sf):
    """D3 as it is scheduled: every hour, the vectors of that hour against the mean of all."""
    vectors = views.vectors(spark, sf)
    rows = drift.drift_windows(views.served_vectors(vectors), drift.baseline_mean(vectors))
    stamps = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return rows.withColumns(stamps).withColumn("drift", F.round("drift", 6))


# --- requests ----------------------------------------------------------------

_REQUESTS = """
    req AS (SELECT conv_id * 1000 + turn AS request_id,
        CASE WHEN conv_id % 9 = 0 THEN 'unknown' WHEN conv_id % 9 = 1 THEN 'score_pair' WHEN conv_id % 9 = 2 THEN 'batch_score'
             ELSE 'rerank' END AS action,
        CASE WHEN role = 'system' THEN '  ' ELSE text END AS query,
        CASE WHEN turn % 2 = 0 THEN text END AS document,
        string_split(text, chr(10)) AS lines, CAST(turn * 20 AS INT) AS top_n FROM conversations)
"""
_REQUEST_ERROR = """
    checked AS (SELECT *, CASE WHEN action = 'unknown' THEN 'Unknown action: unknown'
      WHEN trim(query) = '' THEN 'Missing ''query'' parameter'
      WHEN action = 'rerank' AND (top_n < 1 OR top_n > 100) THEN 'top_n must be 1..100'
      WHEN action = 'score_pair' AND document IS NULL THEN 'Missing ''document'' parameter' END AS error FROM req)
"""
# Same words, counted through rows instead of arrays.
_FEATURES = r"""
    qw AS (SELECT DISTINCT key, w FROM (SELECT key, unnest(string_split_regex(lower(query), '\s+')) AS w FROM pairs) WHERE w <> ''),
    dw AS (SELECT DISTINCT key, w FROM (SELECT key, unnest(string_split_regex(lower(text), '\s+')) AS w FROM pairs) WHERE w <> ''),
    f AS (SELECT p.*, coalesce(nq, 0) AS nq, coalesce(nd, 0) AS nd, coalesce(nb, 0) AS nb FROM pairs p
      LEFT JOIN (SELECT key, count(*) AS nq FROM qw GROUP BY key) USING (key)
      LEFT JOIN (SELECT key, count(*) AS nd FROM dw GROUP BY key) USING (key)
      LEFT JOIN (SELECT key, count(*) AS nb FROM qw JOIN dw USING (key, w) GROUP BY key) USING (key)),
    scored AS (SELECT *, 1 / (1 + exp(-(-2.0 + 3.0 * coalesce(nb / nullif(nq, 0), 0)
      + 4.0 * coalesce(nb / nullif(nq + nd - nb, 0), 0) + 1.0 * coalesce(least(nq, nd) / nullif(greatest(nq, nd), 0), 0)))) AS score FROM f)
"""


def _requests(spark, sf):
    """A rerank request per conversation turn: every line is a document, every
    third one without an id."""
    line = lambda t, i: F.struct(
        F.when(i % 3 != 0, F.concat(F.lit("d"), i.cast("string"))).alias("id"),
        F.nullif(t, F.lit("")).alias("text"),
        F.lit(None).cast("map<string,string>").alias("metadata"),
    )
    rows = table(spark, sf, "conversations").withColumn("action", F.expr(
        "CASE conv_id % 9 WHEN 0 THEN 'unknown' WHEN 1 THEN 'score_pair' WHEN 2 THEN 'batch_score' ELSE 'rerank' END"
    ))
    return rows.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"),
        "action",
        F.when(F.col("role") == "system", "  ").otherwise(F.col("text")).alias("query"),
        F.when(F.col("turn") % 2 == 0, F.col("text")).alias("document"),
        F.transform(F.split("text", "\n"), line).alias("documents"),
        (F.col("turn") * 20).cast("int").alias("top_n"),
    )


@query("request_validation", f"WITH {_REQUESTS}, {_REQUEST_ERROR} SELECT request_id, action, error FROM checked")
def request_validation(spark, sf):
    """P13."""
    return rerank.validate_rerank(_requests(spark, sf)).select("request_id", "action", "error")


@query(
    "embed_request_validation",
    """
    SELECT conv_id * 1000 + turn AS request_id, CASE WHEN turn % 3 = 2 THEN 'Unknown action: pool'
      WHEN turn % 3 = 0 AND role = 'system' THEN 'Missing ''text'' parameter'
      WHEN turn % 3 = 1 AND role <> 'user' THEN 'Missing or invalid ''texts'' parameter'
      WHEN turn % 3 = 1 AND len(string_split(text, ' ')) > 100 THEN 'texts must have 1..100 items' END AS error
    FROM conversations
    """,
)
def embed_request_validation(spark, sf):
    """P13 for embedding requests."""
    rows = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"),
        F.expr("CASE turn % 3 WHEN 0 THEN 'embed' WHEN 1 THEN 'batch_embed' ELSE 'pool' END").alias("action"),
        F.when(F.col("role") != "system", F.col("text")).alias("text"),
        F.when(F.col("role") == "user", F.split("text", " ")).alias("texts"),
    )
    return rerank.validate_embed(rows).select("request_id", "error")


@query(
    "rerank_requests",
    rf"""
    WITH {_REQUESTS}, {_REQUEST_ERROR},
    docs AS (SELECT request_id, query, top_n, i AS pos, lines[i + 1] AS text FROM (
        SELECT *, unnest(range(0, len(lines))) AS i FROM checked WHERE error IS NULL AND action = 'rerank')),
    pairs AS (SELECT *, request_id * 10000 + pos AS key FROM docs), {_FEATURES},
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY round(score, 9) DESC, pos) AS INT) AS rank FROM scored)
    SELECT request_id, rank, CASE WHEN pos % 3 = 0 THEN '' ELSE 'd' END || pos AS id, text, round(score, 6) AS score
    FROM ranked WHERE rank <= top_n
    """,
)
def rerank_requests(spark, sf):
    """P14, G3, W1, F3, X7 with fixed weights."""
    out = rerank.rerank(_requests(spark, sf), rerank.LinearScorer())
    return out.select("request_id", "rank", "id", "text", F.round("score", 6).alias("score"))


@query(
    "pair_scores",
    rf"""
    WITH {_REQUESTS}, {_REQUEST_ERROR},
    docs AS (SELECT request_id, query, CAST(i AS INT) AS pos, lines[i + 1] AS text FROM (
        SELECT *, unnest(range(0, len(lines))) AS i FROM checked WHERE error IS NULL AND action = 'batch_score')
      UNION ALL SELECT request_id, query, 0, document FROM checked WHERE error IS NULL AND action = 'score_pair'),
    pairs AS (SELECT *, request_id * 10000 + pos AS key FROM docs), {_FEATURES}
    SELECT request_id, pos, round(score, 6) AS score FROM scored
    """,
)
def pair_scores(spark, sf):
    """Single pairs and whole batches."""
    out = rerank.score_pairs(_requests(spark, sf), rerank.LinearScorer())
    return out.withColumn("score", F.round("score", 6))


# --- models --------------------------------------------------------------------


def _questions(spark, sf):
    return views.train_pairs(spark, sf)


@query("encode_corpus")
def encode_corpus(spark, sf):
    """Hashed TF-IDF vectors of every document."""
    docs = views.corpus(spark, sf).select("cid", "text")
    return HashedEncoder.fit(docs).encode(docs)


@query(
    "encode_corpus_words",
    r"""
    WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda t: length(t) > 0) AS words FROM documents),
    x AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM t),
    p AS (SELECT words[i] AS a, words[i + 1] AS b, count(*) AS n FROM x GROUP BY 1, 2),
    near AS (SELECT a AS word, a AS other, n FROM p UNION ALL SELECT a, b, n FROM p WHERE b IS NOT NULL UNION ALL SELECT b, a, n FROM p WHERE b IS NOT NULL),
    raw AS (SELECT word, k, sum(n * (2 * ((('0x' || substr(md5('0:' || other), 1, 8))::BIGINT >> k) & 1) - 1))::DOUBLE AS v
            FROM near, range(0, 16) r(k) GROUP BY ALL),
    unit AS (SELECT word, k, coalesce(v / nullif(sqrt(sum(v * v) OVER (PARTITION BY word)), 0), 0) AS v FROM raw),
    tf AS (SELECT doc_id, words[i] AS word, count(*) AS n FROM x GROUP BY ALL),
    s AS (SELECT doc_id, k, sum(n * v) AS v FROM tf JOIN unit USING (word) GROUP BY ALL),
    u AS (SELECT doc_id, k, v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)) AS v FROM s)
    SELECT d.doc_id AS cid, r.k::INT AS dim, round(coalesce(v, 0), 6) + 0.0 AS value
    FROM documents d CROSS JOIN range(0, 16) r(k) LEFT JOIN u ON u.doc_id = d.doc_id AND u.k = r.k
    """.replace("\\\\", "\\"),
)
def encode_corpus_words(spark, sf):
    """Averaged word vectors learned from the whole corpus, component by component."""
    docs = views.corpus(spark, sf).select("cid", "text")
    encoded = AveragedWordEncoder.fit(docs, dim=16).encode(docs, kind="double")
    return encoded.select("cid", F.posexplode("embedding").alias("dim", "value")).withColumn("value", F.round("value", 6) + F.lit(0.0))


@query("retrieve_rerank")
def retrieve_rerank(spark, sf):
    """Every question against all replies, reranked by the pair scorer."""
    pairs = _questions(spark, sf)
    corpus = pairs.select("cid", F.col("reply").alias("text"))
    return retrieve_and_rerank(
        pairs.select("qid", "question"), corpus, HashedEncoder.fit(corpus), rerank.LinearScorer()
    )


@query("rerank_gain")
def rerank_gain(spark, sf):
    """Reciprocal rank of the true reply after reranking minus before."""
    pairs = _questions(spark, sf)
    corpus = pairs.select("cid", F.col("reply").alias("text"))
    found = retrieve_and_rerank(
        pairs.select("qid", "question"), corpus, HashedEncoder.fit(corpus), rerank.LinearScorer(), 50, 50
    )
    qrels, sizes = pairs.select("qid", "cid"), pairs.select("qid", F.lit(1).alias("n_truth"))
    after = ranking_metrics.per_query(ranking_metrics.judge(found, qrels), sizes, (), (), (10,))
    ordered = found.withColumn("rank", F.col("retrieval_rank"))
    before = ranking_metrics.per_query(ranking_metrics.judge(ordered, qrels), sizes, (), (), (10,))
    return ranking_metrics.improvement(before, after, "mrr")


@query("rerank_model")
def rerank_model(spark, sf):
    """A scorer learned from question/reply pairs and mined negatives."""
    pairs = _questions(spark, sf)
    corpus = pairs.select("cid", F.col("reply").alias("text"))
    encoder = HashedEncoder.fit(corpus)
    queries = encoder.encode(pairs.select("qid", "question", F.array("cid").alias("cid")), "question")
    ranking = exact_topk(queries, encoder.encode(corpus), 50)
    known = queries.drop("embedding")
    mined = mining.mined_pairs(known, mining.hard_negatives(known, ranking, 10, min_score=0.0))
    resolved = mined.withColumn(
        "doc_cid", clean.resolved_document(F.col("label"), F.col("positive_cid"), F.col("negative_cid"))
    )
    data = rerank.pair_features(clean.attach_text(resolved, corpus, "doc_cid"), document="document")
    # Fitting reads the pairs more than once and scoring reads them again.
    data = stored(data.select("qid", "doc_cid", "label", *rerank.FEATURES))
    scored = rerank.LearnedScorer.fit(data).score(data, document="document")
    return scored.select("qid", "doc_cid", "label", "score")
