"""Separate bootstraps of few distinct rows are counted in one pass, and give the trees of separate fits."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from foldwright.operators import bagging
from foldwright.staging import stage


def flag_rows(spark, n=3000):
    flags = F.array(*[(F.xxhash64("id", F.lit(i)) % 3 == 0).cast("double") for i in range(5)])
    label = (F.xxhash64("id") % 2 == 0).cast("double")
    return stage(spark.range(n, numPartitions=4).select("id", label.alias("label"), array_to_vector(flags).alias("features")), "flags")


@pytest.mark.parametrize("depth,fraction", [(1, 1.0), (4, 0.5)])
def test_trees_are_those_of_separate_fits(spark, monkeypatch, depth, fraction):
    rows = flag_rows(spark)
    seen = []
    plain_fit = bagging.tree_fit

    def counted(table, *args, **settings):
        seen.append(table.count())
        return plain_fit(table, *args, **settings)

    def fitted():
        trees = bagging.bagging_fit(rows, 3, fraction, depth, strategy="separate", key="id", parallelism=1)
        return [t.toDebugString.split("\n", 1)[1] for t in trees]

    monkeypatch.setattr(bagging, "tree_fit", counted)
    shared = fitted()
    # Two classes of at most 32 vectors each.
    assert len(seen) == 3 and max(seen) <= 64
    monkeypatch.setattr(bagging, "shared_bootstraps", lambda *_: None)
    assert fitted() == shared and min(seen[3:]) > 1000


def test_many_values_are_fitted_on_all_rows(spark, monkeypatch):
    rows = flag_rows(spark, 200).withColumn("features", array_to_vector(F.array(F.col("id").cast("double"))))
    assert bagging.shared_bootstraps(rows, "id", 2, 42, 1.0, "label", "features") is None
    monkeypatch.setattr(bagging, "_SMALL_TABLE", 10)
    assert bagging.shared_bootstraps(rows, "id", 2, 42, 1.0, "label", "features") is None
