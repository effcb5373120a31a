"""Checked queries: classification metrics, losses, runs and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestream.functions.text import metric_key
from lodestream.operators import losses, pair_metrics, runs
from lodestream.plans import views
from lodestream.plans.catalog_retrieval import retrieval_metrics
from lodestream.plans.registry import ORACLES, query, table

_S = f"s AS ({views.SCORED_PAIRS_SQL})"
_RATES = """
    CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
    coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
    coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0) AS specificity
"""
_COUNTS = """
    count(*) FILTER (WHERE score >= {t} AND label = 1) AS tp, count(*) FILTER (WHERE score < {t} AND label = 0) AS tn,
    count(*) FILTER (WHERE score >= {t} AND label = 0) AS fp, count(*) FILTER (WHERE score < {t} AND label = 1) AS fn
"""
# Mann-Whitney over ranks: a second way to the same area.
_AUC = """
    (SELECT coalesce((sum(r) FILTER (WHERE label = 1) - p * (p + 1) / 2.0) / nullif(p * n, 0), 0) FROM (
      SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM s),
      (SELECT CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p, CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS n FROM s)
     GROUP BY p, n)
"""


@query(
    "confusion_counts",
    f"""
    WITH {_S} SELECT tp AS true_positives, tn AS true_negatives, fp AS false_positives, fn AS false_negatives
    FROM (SELECT {_COUNTS.format(t=0.5)} FROM s)
    """,
)
def confusion_counts(spark, sf):
    """A8, P11."""
    return pair_metrics.confusion_counts(views.scored_pairs(spark, sf))


def _metrics_sql() -> str:
    names = [("accuracy", "accuracy"), ("precision", "precision"), ("recall", "recall"), ("f1", "f1"),
             ("specificity", "specificity"), ("sensitivity", "recall"), ("true_positives", "tp"),
             ("true_negatives", "tn"), ("false_positives", "fp"), ("false_negatives", "fn")]
    rows = " UNION ALL ".join(f"SELECT '{n}' AS metric, round(CAST({c} AS DOUBLE), 6) AS value FROM r" for n, c in names)
    return f"""
    WITH {_S}, c AS (SELECT {_COUNTS.format(t=0.5)} FROM s), r AS (SELECT *, {_RATES} FROM c)
    {rows} UNION ALL SELECT 'auc_roc', round({_AUC}, 6)
    """


@query("pair_metrics", _metrics_sql())
def all_pair_metrics(spark, sf):
    """A8–A11, D6."""
    rows = pair_metrics.all_metrics(views.scored_pairs(spark, sf))
    return rows.select("metric", F.round("value", 6).alias("value"))


@query("roc_auc", f"WITH {_S} SELECT round({_AUC}, 6) AS auc_roc")
def roc_auc(spark, sf):
    """A11."""
    return pair_metrics.roc_auc(views.scored_pairs(spark, sf)).select(F.round("auc_roc", 6).alias("auc_roc"))


@query(
    "threshold_sweep",
    f"""
    WITH {_S}, c AS (SELECT CAST(t AS DOUBLE) AS threshold, {_COUNTS.format(t="t")} FROM s,
        (VALUES (0.3::DOUBLE), (0.4::DOUBLE), (0.5::DOUBLE), (0.6::DOUBLE), (0.7::DOUBLE)) v(t) GROUP BY t),
    r AS (SELECT *, {_RATES} FROM c)
    SELECT threshold, tp AS true_positives, round(precision, 6) AS precision, round(recall, 6) AS recall,
           round(f1, 6) AS f1, round(specificity, 6) AS specificity FROM r
    """,
)
def threshold_sweep(spark, sf):
    """A12, A10."""
    rows = pair_metrics.threshold_sweep(views.scored_pairs(spark, sf))
    rounded = [F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "specificity")]
    return rows.select("threshold", "true_positives", *rounded)


@query(
    "classification_report",
    f"""
    WITH {_S}, c AS (SELECT {_COUNTS.format(t=0.5)} FROM s),
    k AS (SELECT 'Not Relevant' AS class_name, coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0) AS p,
                 coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0) AS r, coalesce(2.0 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f,
                 tn + fp AS n FROM c
          UNION ALL SELECT 'Relevant', coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0),
                 coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), coalesce(2.0 * tp / nullif(2 * tp + fn + fp, 0), 0), tp + fn FROM c)
    SELECT class_name, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1, n AS support FROM k
    UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT round(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 4) AS a, tp + tn + fp + fn AS n FROM c)
    UNION ALL SELECT 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4), CAST(sum(n) AS BIGINT) FROM k
    UNION ALL SELECT 'weighted avg', round(sum(p * n) / sum(n), 4), round(sum(r * n) / sum(n), 4), round(sum(f * n) / sum(n), 4),
                     CAST(sum(n) AS BIGINT) FROM k
    """,
)
def classification_report(spark, sf):
    """A13, four digits."""
    rows = pair_metrics.classification_report(views.scored_pairs(spark, sf))
    return rows.select("class_name", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "failed_pairs",
    f"""
    WITH {_S} SELECT pair_id, label, round(score, 6) AS score, CAST(score >= 0.5 AS INT) AS predicted_label,
      CASE WHEN score >= 0.5 THEN 'False Positive' ELSE 'False Negative' END AS error_type
    FROM s WHERE CAST(score >= 0.5 AS INT) <> label
    """,
)
def failed_pairs(spark, sf):
    """T9."""
    return pair_metrics.failed_pairs(views.scored_pairs(spark, sf)).withColumn("score", F.round("score", 6))


@query(
    "bce_loss",
    f"""
    WITH {_S}, p AS (SELECT 1 / (1 + exp(-(8 * score - 4))) AS y, label FROM s)
    SELECT round(avg(-(label * ln(y) + (1 - label) * ln(1 - y))), 6) AS loss FROM p
    """,
)
def bce_loss(spark, sf):
    """A24, from logits."""
    pairs = views.scored_pairs(spark, sf).withColumn("logit", 8 * F.col("score") - 4)
    return losses.bce_from_logits(pairs).select(F.round("loss", 6).alias("loss"))


@query(
    "margin_loss",
    """
    SELECT round(avg(CASE WHEN l_tax - l_discount + 0.05 > 0 THEN l_tax - l_discount + 0.05 ELSE 0 END), 6) AS loss FROM lineitem
    """,
)
def margin_loss(spark, sf):
    """A25 on two measures of every line item."""
    pairs = table(spark, sf, "lineitem").select(F.col("l_discount").alias("pos_score"), F.col("l_tax").alias("neg_score"))
    return losses.margin_loss(pairs, margin=0.05).select(F.round("loss", 6).alias("loss"))


# --- runs ------------------------------------------------------------------------

_LOG = f"l AS ({views.EPOCH_LOG_SQL})"


@query(
    "best_epoch",
    f"""
    WITH {_LOG} SELECT run_id, epoch AS best_epoch, round(val_loss, 6) AS best_loss FROM (
      SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY val_loss, epoch) AS r FROM l) WHERE r = 1
    """,
)
def best_epoch(spark, sf):
    """A34."""
    return runs.best_epoch(views.epoch_log(spark, sf)).withColumn("best_loss", F.round("best_loss", 6))


@query(
    "early_stop",
    f"""
    WITH RECURSIVE {_LOG}, o AS (SELECT run_id, epoch, val_loss, row_number() OVER (PARTITION BY run_id ORDER BY epoch) AS i FROM l),
    f AS (SELECT run_id, i, epoch, val_loss AS best, 0 AS waited FROM o WHERE i = 1
      UNION ALL SELECT o.run_id, o.i, o.epoch, CASE WHEN val_loss < best - 0.001 THEN val_loss ELSE best END,
        CASE WHEN val_loss < best - 0.001 THEN 0 ELSE waited + 1 END FROM f JOIN o ON o.run_id = f.run_id AND o.i = f.i + 1)
    SELECT run_id, CAST(min(epoch) FILTER (WHERE waited >= 3) AS BIGINT) AS stop_epoch FROM f GROUP BY run_id
    """,
)
def early_stop(spark, sf):
    """A35."""
    return runs.early_stop(views.epoch_log(spark, sf))


@query(
    "epoch_mean_loss",
    """
    SELECT user_id AS run_id, CAST(day(ts) AS INT) AS epoch, round(avg(value), 6) AS mean_loss FROM events GROUP BY 1, 2
    """,
)
def epoch_mean_loss(spark, sf):
    """A36."""
    steps = table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), F.dayofmonth("ts").alias("epoch"), F.col("value").alias("loss")
    )
    return runs.epoch_losses(steps).withColumn("mean_loss", F.round("mean_loss", 6))


@query(
    "metric_log",
    """
    SELECT event_id AS step, 'train/' || replace(event_type || '@5', '@', '_at_') AS metric, value FROM events WHERE event_id % 10 = 0
    UNION ALL SELECT event_id, 'val/' || replace(event_type || '@5', '@', '_at_'), value FROM events
    """,
)
def metric_log(spark, sf):
    """The operator keeps every tenth training step."""
    metrics = table(spark, sf, "events").select(
        F.col("event_id").alias("step"), metric_key(F.concat("event_type", F.lit("@5"))).alias("metric"), "value"
    )
    return runs.metric_log(metrics).unionByName(runs.metric_log(metrics, phase="val"))


_RUNS = f"m AS ({views.RUN_METRICS_SQL})"


@query(
    "latest_version",
    f"""
    WITH {_RUNS}, v AS (SELECT DISTINCT model, version FROM m)
    SELECT model, max(version) AS version FROM v GROUP BY model
    """,
)
def latest_version(spark, sf):
    """11 is later than 9, as numbers."""
    versions = views.run_metrics(spark, sf).select("model", F.col("version").cast("string").alias("version"))
    return runs.latest_version(versions)


_COMPARED = """
    c AS (SELECT model, metric, max(value) FILTER (WHERE version = 9) AS v_first, max(value) FILTER (WHERE version = 10) AS v_second
          FROM m WHERE version IN (9, 10) GROUP BY model, metric)
"""


@query(
    "version_compare",
    f"WITH {_RUNS}, {_COMPARED} SELECT model, metric, round(v_first, 6) AS v_first, round(v_second, 6) AS v_second FROM c",
)
def version_compare(spark, sf):
    """One model has no second version; its values stay null."""
    rows = runs.compare_versions(views.run_metrics(spark, sf), 9, 10)
    return rows.withColumns({c: F.round(c, 6) for c in ("v_first", "v_second")})


@query(
    "performance_drop",
    f"""
    WITH {_RUNS}, {_COMPARED}
    SELECT model, metric, round((v_first - v_second) / abs(v_first), 6) AS "drop",
           coalesce((v_first - v_second) / abs(v_first) > 0.05, false) AS dropped FROM c
    """,
)
def performance_drop(spark, sf):
    """D4."""
    rows = runs.performance_drop(runs.compare_versions(views.run_metrics(spark, sf), 9, 10))
    return rows.select("model", "metric", F.round("drop", 6).alias("drop"), "dropped")


_GATE = f"""
    bi AS ({ORACLES["retrieval_metrics"]}),
    cross_ AS ({ORACLES["pair_metrics"]}),
    g AS (SELECT (SELECT value FROM bi WHERE metric = 'mrr') AS bi_mrr,
           (SELECT value FROM bi WHERE metric = 'recall@10') AS bi_recall_at_10,
           (SELECT value FROM cross_ WHERE metric = 'auc_roc') AS cross_auc,
           (SELECT value FROM cross_ WHERE metric = 'recall') AS cross_recall,
           CAST((SELECT value FROM cross_ WHERE metric = 'true_positives') AS BIGINT) AS cross_tp),
    verdict AS (SELECT *, bi_mrr >= 0.35 AND bi_recall_at_10 >= 0.6 AS bi_encoder_pass,
           cross_tp > 0 AND cross_auc >= 0.65 AND cross_recall >= 0.05 AS cross_encoder_pass FROM g)
"""


@query("gate_verdict", f"WITH {_GATE} SELECT *, bi_encoder_pass AND cross_encoder_pass AS passed FROM verdict")
def gate_verdict(spark, sf):
    """Retriever and pair metrics of the given tables."""
    return runs.gate(retrieval_metrics(spark, sf), all_pair_metrics(spark, sf))


@query(
    "gate_summary",
    f"""
    WITH {_GATE}
    SELECT bi_encoder_pass AND cross_encoder_pass AS passed,
      CASE WHEN bi_encoder_pass AND cross_encoder_pass THEN '🚀 *RETRIEVAL MODEL CANDIDATE*' ELSE '⚠️ *RETRIEVAL MODEL FAILED GATE*' END
      || chr(10) || chr(10) || '🧠 *Bi-Encoder*' || chr(10) || printf('📊 MRR: `%.4f`', bi_mrr) || chr(10)
      || printf('🎯 Recall@10: `%.4f`', bi_recall_at_10) || chr(10)
      || '🚦 Gate: `' || CASE WHEN bi_encoder_pass THEN 'PASS ✅' ELSE 'FAIL ❌' END || '`' || chr(10) || chr(10)
      || '⚖️ *Cross-Encoder*' || chr(10) || printf('📈 AUC: `%.4f`', cross_auc) || chr(10)
      || printf('🎯 Recall: `%.4f`', cross_recall) || chr(10) || '🧮 True Positives: `' || cross_tp || '`' || chr(10)
      || '🚦 Gate: `' || CASE WHEN cross_encoder_pass THEN 'PASS ✅' ELSE 'FAIL ❌' END || '`' || chr(10) || chr(10)
      || '📌 *Overall Status*: **' || CASE WHEN bi_encoder_pass AND cross_encoder_pass THEN '🟢 PASSED' ELSE '🔴 FAILED' END || '**' AS message
    FROM verdict
    """,
)
def gate_summary(spark, sf):
    """F13."""
    return runs.gate_summary(gate_verdict(spark, sf))
