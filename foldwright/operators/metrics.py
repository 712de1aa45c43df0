"""Exact classification metrics for all groups (model, fold, ...) of a prediction table at once.

Every function takes ``(preds, keys)``: ``preds`` has a 0/1 ``label``, a
``prediction`` and a ``score`` column, ``keys`` name the groups. Rows without a label
count in no metric, rows without a prediction in none that reads it; only the
confusion matrix shows them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwright.operators.ordered import (
    RANGE,
    before_in_range,
    cut_into_ranges,
    earlier_ranges,
    running_totals,
)

FOLD_METRICS = ["auc", "accuracy", "weighted_precision", "weighted_recall", "weighted_f1"]


def confusion_matrix(preds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, label, prediction, n)``."""
    label, prediction = F.col("label").cast("int"), F.col("prediction").cast("int")
    return preds.groupBy(*keys, label.alias("label"), prediction.alias("prediction")).agg(F.count("*").alias("n"))


def _judged(preds: DataFrame) -> DataFrame:
    return preds.filter(F.col("label").isNotNull() & F.col("prediction").isNotNull())


def accuracy(preds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, accuracy)``: share of rows whose prediction equals the label."""
    hit = (F.col("label").cast("double") == F.col("prediction").cast("double")).cast("double")
    return _judged(preds).groupBy(*keys).agg(F.avg(hit).alias("accuracy"))


def _class_scores(preds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per true class: its rows, precision, recall and F1, a rate with no rows under it being 0."""
    cells = confusion_matrix(_judged(preds), keys)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    classes = cells.select(
        *keys,
        F.inline(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    hit.alias("hits"),
                ),
                F.struct(
                    F.col("prediction").alias("class"),
                    F.lit(0).cast("bigint").alias("actual"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        ),
    )
    sums = classes.groupBy(*keys, "class").agg(
        F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    zero = F.lit(0.0)
    return sums.filter(F.col("actual") > 0).select(
        *keys,
        "actual",
        F.coalesce(F.try_divide("hits", "predicted"), zero).alias("precision"),
        F.try_divide("hits", "actual").alias("recall"),
        # 2PR / (P + R) with the common factor taken out
        F.coalesce(F.try_divide(2.0 * F.col("hits"), F.col("actual") + F.col("predicted")), zero).alias("f1"),
    )


def _weighted(rate: str) -> Column:
    return F.sum(F.col("actual") * F.col(rate)) / F.sum("actual")


def _weighted_metric(preds: DataFrame, keys: Sequence[str], rate: str, out: str) -> DataFrame:
    return _class_scores(preds, keys).groupBy(*keys).agg(_weighted(rate).alias(out))


def weighted_precision(preds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, weighted_precision)``: mean precision of the classes, weighted by their rows."""
    return _weighted_metric(preds, keys, "precision", "weighted_precision")


def weighted_recall(preds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, weighted_recall)``; equal to the accuracy."""
    return _weighted_metric(preds, keys, "recall", "weighted_recall")


def weighted_f1(preds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, weighted_f1)``: mean F1 of the classes, not the F1 of the positive class."""
    return _weighted_metric(preds, keys, "f1", "weighted_f1")


def _by_score(preds: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Positive and negative rows at each distinct score, as doubles: their products pass 64 bits."""
    positive = F.count_if(F.col("label") == 1).cast("double")
    negative = F.count_if(F.col("label") == 0).cast("double")
    return preds.groupBy(*keys, F.col(score).alias("score")).agg(positive.alias("pos"), negative.alias("neg"))


def auc_roc(preds: DataFrame, keys: Sequence[str], score: str = "score") -> DataFrame:
    """``(keys, auc)``: exact area under the ROC curve, equal scores sharing their rank; null for one class only.

    It is the share of (positive, negative) pairs that are in the right order. Rows
    are first counted per score, then each range of scores is summed on its own; a
    range adds its own pairs and, for its positives, all negatives of lower ranges.
    """
    ranges = cut_into_ranges(_by_score(preds, keys, score), keys, "score")
    lower = F.coalesce(F.sum("neg").over(before_in_range(keys, "score")), F.lit(0.0))
    inside = (
        ranges.withColumn("lower", lower)
        .groupBy(*keys, RANGE)
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum(F.col("pos") * (F.col("lower") + F.col("neg") / 2)).alias("pairs"),
        )
    )
    below = F.coalesce(F.sum("neg").over(earlier_ranges(keys)), F.lit(0.0))
    ordered = F.sum(F.col("pairs") + F.col("pos") * F.col("below"))
    return (
        inside.withColumn("below", below)
        .groupBy(*keys)
        .agg(F.try_divide(ordered, F.sum("pos") * F.sum("neg")).alias("auc"))
    )


def roc_curve(preds: DataFrame, keys: Sequence[str], score: str = "score") -> DataFrame:
    """``(keys, threshold, tp, fp, tpr, fpr)``: counts at or above each distinct score; rates null for a missing class."""
    points = running_totals(_by_score(preds, keys, score), keys, "score", ["pos", "neg"], descending=True)
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    return points.select(
        *keys,
        F.col("score").alias("threshold"),
        tp.cast("bigint").alias("tp"),
        fp.cast("bigint").alias("fp"),
        F.try_divide(tp, F.col("pos_total")).alias("tpr"),
        F.try_divide(fp, F.col("neg_total")).alias("fpr"),
    )


def fold_metrics(preds: DataFrame, keys: Sequence[str], metrics: Sequence[str] = tuple(FOLD_METRICS)) -> DataFrame:
    """``(keys, metric, value)`` for all groups: one pass for the counted metrics, one for the AUC."""
    unknown = set(metrics) - set(FOLD_METRICS)
    if unknown:
        raise ValueError(f"unknown metrics {sorted(unknown)}")
    counted = [m for m in metrics if m != "auc"]
    parts = []
    if counted:
        # The weighted recall is the accuracy.
        source = {
            "accuracy": "recall",
            "weighted_precision": "precision",
            "weighted_recall": "recall",
            "weighted_f1": "f1",
        }
        wide = _class_scores(preds, keys).groupBy(*keys).agg(*[_weighted(source[m]).alias(m) for m in counted])
        parts.append(wide.unpivot(list(keys), counted, "metric", "value"))
    if "auc" in metrics:
        parts.append(auc_roc(preds, keys).select(*keys, F.lit("auc").alias("metric"), F.col("auc").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def cv_summary(metrics: DataFrame) -> DataFrame:
    """``(model, metric, mean, std, n_folds)``, with the population standard deviation.

    ``n_folds`` counts the folds that have the metric: a fold of one class has no AUC.
    """
    return metrics.groupBy("model", "metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("n_folds")
    )


def fold_series(metrics: DataFrame) -> DataFrame:
    """``(model, metric, fold, value, mean)``: each fold's score beside the mean line."""
    line = Window.partitionBy("model", "metric")
    return metrics.select("model", "metric", "fold", "value", F.avg("value").over(line).alias("mean"))


def score_dict(metrics: DataFrame, model: str) -> dict[str, dict]:
    """``{metric: {mean, std, scores}}`` of one model; one value per metric and fold reaches the driver."""
    scores = F.transform(F.array_sort(F.collect_list(F.struct("fold", "value"))), lambda s: s["value"])
    rows = (
        metrics.filter(F.col("model") == model)
        .groupBy("metric")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), scores.alias("scores"))
        .collect()
    )
    return {r["metric"]: {"mean": r["mean"], "std": r["std"], "scores": list(r["scores"])} for r in rows}
