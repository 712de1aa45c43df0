"""Comparing models by their cross-validated metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPARED = ["auc", "accuracy", "weighted_f1"]


def model_comparison(metrics: DataFrame, models: Sequence[str], compared: Sequence[str] = tuple(COMPARED)) -> DataFrame:
    """``(position, model, <m>_mean, <m>_std...)``: one row per model, positions in the order of ``models``."""
    wide = (
        metrics.filter(F.col("model").isin(list(models)))
        .groupBy("model")
        .pivot("metric", list(compared))
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    )
    position = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model")).cast("int")
    return wide.withColumn("position", position)


def best_model(comparison: DataFrame, metric: str = "auc") -> DataFrame:
    """The row with the highest mean; the earlier position wins a tie, a model without a value loses."""
    return comparison.orderBy(F.desc_nulls_last(f"{metric}_mean"), "position").limit(1)
