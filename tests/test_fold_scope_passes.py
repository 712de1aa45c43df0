"""Slots are made once for logistic fits by training part, with the rows of a preparation by training part."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import StandardScaler, StringIndexer
from pyspark.sql import functions as F

from foldwright.operators import folds, learners, prep
from foldwright.staging import stage

K = 2


def noise(i):
    return F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000.0


def applicants(spark, n=600):
    """Numbers with gaps and NaN, categories with nulls, a value that occurs in fold 1 alone, and a constant."""
    rows = spark.range(n, numPartitions=2).withColumn("fold", (F.col("id") % K).cast("int"))
    common = F.when(F.col("id") % 11 != 0, (F.col("id") % 3).cast("string"))
    return stage(
        rows.select(
            "*",
            (noise(1) + 0.3 * (F.col("id") % 3) > 0.7).cast("int").alias("label"),
            F.when(F.col("id") % 7 != 0, F.when(F.col("id") % 13 != 0, 90 * (noise(1) + noise(2))).otherwise(float("nan"))).alias("a"),
            (noise(3) * 9).cast("int").alias("b"),
            F.lit(5).alias("same"),
            F.when(F.col("id").isin(41, 43, 47), "rare").otherwise(common).alias("c"),
        ),
        "rows",
    )


@pytest.fixture()
def fits(monkeypatch):
    seen = []
    for kind in (StringIndexer, StandardScaler, LogisticRegression, LinearSVC):
        plain = kind.fit
        monkeypatch.setattr(kind, "fit", lambda self, *a, plain=plain: seen.append(type(self).__name__) or plain(self, *a))
    return seen


def validated(rows, estimator, by_part=False):
    """By fold; ``by_part`` hides that these are the stages of ``prep_pipeline``."""
    pipeline = prep.prep_pipeline(["a", "b", "same"], ["c"])
    pipeline = Pipeline(stages=pipeline.getStages()) if by_part else pipeline
    return folds.cross_validate(rows, learners.estimator_predictor(estimator), K, ["id"], pipeline, fit_scope="fold", staged=True)


@pytest.mark.parametrize("settings", [{}, {"reg": 0.0}, {"mix": 0.0, "max_iter": 3}])
def test_slots_are_made_once_with_the_same_rows(spark, fits, settings):
    rows = applicants(spark)
    shared = {r["id"]: r for r in validated(rows, learners.logreg(**settings)).collect()}
    assert sorted(fits) == ["LogisticRegression"] * K + ["StringIndexer"]
    fits.clear()
    single = {r["id"]: r for r in validated(rows, learners.logreg(**settings), by_part=True).collect()}
    assert fits.count("StandardScaler") == fits.count("StringIndexer") == K
    assert shared.keys() == single.keys() and 41 in shared and len(shared) < 600
    for i, row in single.items():
        assert (shared[i]["fold"], shared[i]["label"], shared[i]["prediction"]) == (row["fold"], row["label"], row["prediction"])
        assert shared[i]["p1"] == pytest.approx(row["p1"], abs=1e-7) and shared[i]["score"] == pytest.approx(row["score"], abs=1e-6)


def test_fits_on_given_scales_are_prepared_by_part(spark, fits):
    validated(applicants(spark, 60), LinearSVC(labelCol="label", maxIter=2))
    assert fits.count("StandardScaler") == K
    for other in (learners.logreg().setStandardization(False), learners.logreg().setFitIntercept(False), learners.logreg().setWeightCol("b")):
        assert not learners.standardizes(other)
