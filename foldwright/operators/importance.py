"""Ranking features by a fitted tree ensemble."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def feature_importance(model, names: Sequence[str]) -> DataFrame:
    """``(rank, feature, importance)``, highest first, ties by slot; ``names`` are the slot names."""
    values = [float(v) for v in model.featureImportances.toArray()]
    if len(values) != len(names):
        raise ValueError(f"{len(values)} importances but {len(names)} names")
    ordered = sorted(range(len(values)), key=lambda slot: (-values[slot], slot))
    rows = [(rank, names[slot], values[slot]) for rank, slot in enumerate(ordered, start=1)]
    spark = SparkSession.active()
    return spark.createDataFrame(rows, "rank int, feature string, importance double")
