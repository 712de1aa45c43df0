"""Fitted models score rows in a session that has observed counts."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Observation
from pyspark.sql import functions as F

from foldwright.operators import boosting, folds, learners, prep
from foldwright.staging import stage


@pytest.fixture(scope="module")
def rows(spark):
    """120 rows, and a session that cannot be serialized any more."""
    x = F.sin(F.col("id"))
    table = spark.range(120, numPartitions=3).select(
        "id", x.alias("x"), (x + F.cos(F.col("id") * 7) > 0).cast("double").alias("label"), (F.col("id") % 3).cast("int").alias("fold")
    )
    seen = Observation()
    staged = stage(table.observe(seen, F.count("*").alias("n")), "observed")
    assert seen.get["n"] == 120
    return staged


@pytest.fixture(scope="module")
def points(rows):
    return rows.withColumn("features", array_to_vector(F.array("x")))


def test_learners_score_rows(points):
    for model in (learners.logreg_fit(points), learners.weak_learner_fit(points.withColumn("w", F.lit(1.0)))):
        assert model.transform(points).filter("prediction = label").count() > 60
    voted, votes = boosting.adaboost_votes(points, boosting.adaboost_fit(points, rounds=2))
    assert len(boosting.weighted_vote(voted, votes).collect()) == 120


@pytest.mark.parametrize("kind", ["logreg", "svc", "pipeline", "one against rest"])
def test_folds_of_estimators_are_scored(points, kind):
    estimator = {
        "logreg": learners.logreg(),
        "svc": LinearSVC(maxIter=5),
        "pipeline": Pipeline(stages=[LogisticRegression(maxIter=5)]),
        "one against rest": OneVsRest(classifier=LogisticRegression(maxIter=5)),
    }[kind]
    if kind == "one against rest":
        fitted = learners.without_summary(estimator.fit(points))
        assert fitted.transform(points).count() == 120 and len(fitted.transform(points).select("prediction").collect()) == 120
        return
    scored = folds.cross_validate(points, learners.estimator_predictor(estimator), 3, ["id"])
    assert len({r["id"] for r in scored.collect()}) == 120


def test_folds_with_their_own_preparation_are_scored(rows):
    predictor = learners.estimator_predictor(learners.logreg(reg=0.0))
    scored = folds.cross_validate(rows, predictor, 3, ["id"], prep.prep_pipeline(["x"], []), fit_scope="fold")
    assert len({r["id"] for r in scored.collect()}) == 120
