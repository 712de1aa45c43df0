"""Of scored rows and the models that score them, the models are sent out."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from foldwright.checks import fold_queries
from foldwright.operators import fold_logistic as fl
from foldwright.staging import stage


def sends_the_models(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "BuildRight" in plan and "BuildLeft" not in plan


def small_rows(spark):
    x = F.array(F.sin("id"), F.cos("id"))
    rows = spark.range(300, numPartitions=3).select(
        "id",
        (F.col("id") % 3).cast("int").alias("fold"),
        (F.sin("id") + F.cos(F.col("id") * 5) > 0).cast("double").alias("label"),
        array_to_vector(x).alias("features"),
    )
    return stage(rows, "small")


def test_predictions_send_the_models(spark):
    rows = small_rows(spark)
    linear = [fl.Linear(0.1, (1.0, -1.0))] * 3
    scored = fl.logistic_predictions(rows, linear, ["id"])
    assert sends_the_models(scored) and scored.count() == 300
    voted = fl.adaboost_predictions(rows, [[fl.LinearRound(m, 0.2, 0.7)] for m in linear], ["id"])
    assert sends_the_models(voted) and voted.count() == 300


def test_reweighting_sends_the_learners(spark, monkeypatch):
    rows = small_rows(spark)
    monkeypatch.setattr(fold_queries, "K", 3)
    monkeypatch.setattr(fold_queries, "prepared_by_fold", lambda *_: rows)
    weighed = fold_queries.fold_adaboost_weights(spark, "")
    assert sends_the_models(weighed)
    assert {(r["n"], r["missed"]) for r in weighed.collect()} == {(200, 0.5)}
