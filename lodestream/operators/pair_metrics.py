"""Classification metrics of scored pairs (score 0..1, label 0/1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.operators.ordered import quantile_bounds, running_sums

# Fixed names and values.
COUNTS = ("true_positives", "true_negatives", "false_positives", "false_negatives")
THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7)
CLASS_NAMES = ("Not Relevant", "Relevant")


def predicted(score: Column, threshold: float = 0.5) -> Column:
    return (score >= threshold).cast("int")


def _counts(threshold: float) -> list[Column]:
    said, true = F.col("score") >= threshold, F.col("label") == 1
    cells = (said & true, ~said & ~true, said & ~true, ~said & true)
    return [F.count_if(cell) for cell in cells]


def confusion_counts(pairs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Always four counts, also when only one class is present."""
    return pairs.agg(*[c.alias(n) for c, n in zip(_counts(threshold), COUNTS)])


def _or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def rates(counts: DataFrame) -> DataFrame:
    """Add accuracy, precision, recall, f1, specificity, sensitivity."""
    tp, tn, fp, fn = (F.col(c) for c in COUNTS)
    return counts.withColumns(
        {
            "accuracy": _or_zero(tp + tn, tp + tn + fp + fn),
            "precision": _or_zero(tp, tp + fp),
            "recall": _or_zero(tp, tp + fn),
            "f1": _or_zero(2 * tp, 2 * tp + fp + fn),
            "specificity": _or_zero(tn, tn + fp),
            "sensitivity": _or_zero(tp, tp + fn),
        }
    )


def threshold_sweep(pairs: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """One row per threshold from a single pass; no row is multiplied."""
    aggs = [F.struct(F.lit(float(t)).alias("threshold"), *[c.alias(n) for c, n in zip(_counts(t), COUNTS)]) for t in thresholds]
    rows = pairs.agg(F.array(*aggs).alias("_rows")).select(F.inline("_rows"))
    return rates(rows)


def roc_auc(pairs: DataFrame, zones: int = 256) -> DataFrame:
    """Area under the ROC curve with ties counted half; 0 with one class only.

    Rows collapse to one per distinct score first, then each positive meets
    the negatives below it through a range-wise running sum. The ranges are cut from
    the distinct scores, so that one score of most rows does not empty them.
    """
    per_score = pairs.groupBy("score").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    running = running_sums(per_score, "score", ["neg"], quantile_bounds(per_score, "score", zones))
    total = running.agg(
        F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0)).alias("won"),
        F.sum("pos").cast("double").alias("p"),
        F.sum("neg").cast("double").alias("n"),
    )
    return total.select(_or_zero(F.col("won"), F.col("p") * F.col("n")).alias("auc_roc"))


def all_metrics(pairs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(metric, value) of every rate and count, and the AUC."""
    wide = rates(confusion_counts(pairs, threshold))
    names = wide.columns
    rows = wide.select(*[F.col(n).cast("double") for n in names]).unpivot([], names, "metric", "value")
    auc = roc_auc(pairs).select(F.lit("auc_roc").alias("metric"), F.col("auc_roc").alias("value"))
    return rows.unionByName(auc)


def classification_report(pairs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per class precision, recall, f1, support; then accuracy and averages."""
    tp, tn, fp, fn = (F.col(c) for c in COUNTS)

    def line(name: str, hit: Column, other: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class_name"),
            _or_zero(hit, hit + other).alias("precision"),
            _or_zero(hit, hit + missed).alias("recall"),
            _or_zero(2 * hit, 2 * hit + other + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    both = confusion_counts(pairs, threshold).withColumns(
        {"c0": line(CLASS_NAMES[0], tn, fn, fp), "c1": line(CLASS_NAMES[1], tp, fp, fn)}
    )
    n = F.col("c0.support") + F.col("c1.support")

    def average(name: str, mix) -> Column:
        cols = [mix(F.col(f"c0.{m}"), F.col(f"c1.{m}")).alias(m) for m in ("precision", "recall", "f1")]
        return F.struct(F.lit(name).alias("class_name"), *cols, n.alias("support"))

    weighted = lambda a, b: _or_zero(a * F.col("c0.support") + b * F.col("c1.support"), n)
    accuracy = _or_zero(tp + tn, n)
    rows = F.array(
        F.col("c0"),
        F.col("c1"),
        average("accuracy", lambda a, b: accuracy),
        average("macro avg", lambda a, b: (a + b) / 2.0),
        average("weighted avg", weighted),
    )
    return both.select(F.inline(rows))


def failed_pairs(pairs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Wrongly decided pairs with the kind of error."""
    decided = pairs.withColumn("predicted_label", predicted(F.col("score"), threshold))
    wrong = decided.where(F.col("predicted_label") != F.col("label"))
    kind = F.when(F.col("predicted_label") == 1, "False Positive").otherwise("False Negative")
    return wrong.withColumn("error_type", kind)


def label_balance(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("label") == 1).alias("positive"),
        F.count_if(F.col("label") == 0).alias("negative"),
    )
