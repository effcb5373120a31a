"""Training-run tables: losses per epoch, versions of a model, quality gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Acceptance limits of a candidate.
MIN_MRR = 0.35
MIN_RECALL_AT_10 = 0.60
MIN_AUC = 0.65
MIN_PAIR_RECALL = 0.05


def epoch_losses(step_losses: DataFrame) -> DataFrame:
    return step_losses.groupBy("run_id", "epoch").agg(F.avg("loss").alias("mean_loss"))


def best_epoch(losses: DataFrame, loss: str = "val_loss") -> DataFrame:
    """Lowest loss; the earliest epoch wins a tie."""
    key = F.struct(loss, "epoch")
    return losses.groupBy("run_id").agg(F.min_by("epoch", key).alias("best_epoch"), F.min(loss).alias("best_loss"))


def early_stop(losses: DataFrame, loss: str = "val_loss", patience: int = 3, min_delta: float = 0.001) -> DataFrame:
    """(run_id, stop_epoch): first epoch at which ``patience`` epochs in a row
    brought no improvement over the best by more than ``min_delta``; null when
    a run never stops. A run's list is its epochs, short by nature."""
    curve = losses.groupBy("run_id").agg(
        F.sort_array(F.collect_list(F.struct("epoch", F.col(loss).cast("double").alias("loss")))).alias("curve")
    )
    start = F.struct(
        F.lit(float("inf")).alias("best"), F.lit(0).alias("waited"), F.lit(None).cast("bigint").alias("stop")
    )

    def step(state: Column, x: Column) -> Column:
        better = x["loss"] < state["best"] - min_delta
        waited = F.when(better, 0).otherwise(state["waited"] + 1)
        stop = F.coalesce(state["stop"], F.when(waited >= patience, x["epoch"].cast("bigint")))
        return F.struct(
            F.when(better, x["loss"]).otherwise(state["best"]).alias("best"), waited.alias("waited"), stop.alias("stop")
        )

    return curve.select("run_id", F.aggregate("curve", start, step)["stop"].alias("stop_epoch"))


def metric_log(metrics: DataFrame, every: int = 10, phase: str = "train") -> DataFrame:
    """Every n-th step of a metric log, names prefixed with the phase."""
    kept = metrics.where(F.col("step") % every == 0) if phase == "train" else metrics
    return kept.withColumn("metric", F.concat(F.lit(f"{phase}/"), F.col("metric")))


def latest_version(versions: DataFrame) -> DataFrame:
    """Row with the numerically largest version of every model."""
    typed = versions.withColumn("version", F.col("version").try_cast("int"))
    rest = [c for c in typed.columns if c != "model"]
    return typed.groupBy("model").agg(F.max_by(F.struct(*rest), "version").alias("_r")).select("model", "_r.*")


def compare_versions(metrics: DataFrame, first: int, second: int, names: Sequence[str] | None = None) -> DataFrame:
    """(model, metric, v_first, v_second); a missing value stays null."""
    rows = metrics.where(F.col("version").isin(first, second))
    if names:
        rows = rows.where(F.col("metric").isin(*names))
    pick = lambda v: F.max(F.when(F.col("version") == v, F.col("value")))
    return rows.groupBy("model", "metric").agg(pick(first).alias("v_first"), pick(second).alias("v_second"))


def performance_drop(compared: DataFrame, limit: float = 0.05) -> DataFrame:
    """Relative loss from first to second version, flagged above the limit."""
    drop = F.try_divide(F.col("v_first") - F.col("v_second"), F.abs("v_first"))
    return compared.withColumn("drop", drop).withColumn("dropped", F.coalesce(F.col("drop") > limit, F.lit(False)))


def pivot_metrics(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """(metric, value) rows → one row with a column per name."""
    return rows.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])


def gate(retriever: DataFrame, pair: DataFrame) -> DataFrame:
    """One verdict row from two (metric, value) tables."""
    r = retriever.where(F.col("metric").isin("mrr", "recall@10")).withColumn("side", F.lit("bi_"))
    p = pair.where(F.col("metric").isin("true_positives", "auc_roc", "recall")).withColumn("side", F.lit("cross_"))
    both = r.unionByName(p).select(F.concat("side", "metric").alias("metric"), "value")
    row = pivot_metrics(both, ["bi_mrr", "bi_recall@10", "cross_auc_roc", "cross_recall", "cross_true_positives"])
    bi_ok = (F.col("bi_mrr") >= MIN_MRR) & (F.col("bi_recall@10") >= MIN_RECALL_AT_10)
    cross_ok = (
        (F.col("cross_true_positives") > 0)
        & (F.col("cross_auc_roc") >= MIN_AUC)
        & (F.col("cross_recall") >= MIN_PAIR_RECALL)
    )
    return row.select(
        "bi_mrr",
        F.col("bi_recall@10").alias("bi_recall_at_10"),
        F.col("cross_auc_roc").alias("cross_auc"),
        "cross_recall",
        F.col("cross_true_positives").cast("bigint").alias("cross_tp"),
        F.coalesce(bi_ok, F.lit(False)).alias("bi_encoder_pass"),
        F.coalesce(cross_ok, F.lit(False)).alias("cross_encoder_pass"),
    ).withColumn("passed", F.col("bi_encoder_pass") & F.col("cross_encoder_pass"))


def gate_summary(verdict: DataFrame) -> DataFrame:
    """Message text of a gate verdict, metrics with four decimals."""
    four = lambda c: F.format_string("%.4f", F.col(c))
    # Fixed texts of the message.
    mark = lambda c: F.when(F.col(c), "PASS ✅").otherwise("FAIL ❌")
    lines = [
        F.when(F.col("passed"), "🚀 *RETRIEVAL MODEL CANDIDATE*").otherwise("⚠️ *RETRIEVAL MODEL FAILED GATE*"),
        F.lit(""),
        F.lit("🧠 *Bi-Encoder*"),
        F.concat(F.lit("📊 MRR: `"), four("bi_mrr"), F.lit("`")),
        F.concat(F.lit("🎯 Recall@10: `"), four("bi_recall_at_10"), F.lit("`")),
        F.concat(F.lit("🚦 Gate: `"), mark("bi_encoder_pass"), F.lit("`")),
        F.lit(""),
        F.lit("⚖️ *Cross-Encoder*"),
        F.concat(F.lit("📈 AUC: `"), four("cross_auc"), F.lit("`")),
        F.concat(F.lit("🎯 Recall: `"), four("cross_recall"), F.lit("`")),
        F.concat(F.lit("🧮 True Positives: `"), F.col("cross_tp").cast("string"), F.lit("`")),
        F.concat(F.lit("🚦 Gate: `"), mark("cross_encoder_pass"), F.lit("`")),
        F.lit(""),
        F.concat(F.lit("📌 *Overall Status*: **"), F.when(F.col("passed"), "🟢 PASSED").otherwise("🔴 FAILED"), F.lit("**")),
    ]
    return verdict.select("passed", F.concat_ws("\n", *lines).alias("message"))
