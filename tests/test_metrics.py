import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

from foldwright.operators import comparison, folds, metrics


@pytest.fixture(scope="module")
def preds(spark):
    """Two folds; a third of all rows share one score."""
    rng = np.random.default_rng(3)
    n = 6000
    pdf = pd.DataFrame({"fold": rng.integers(0, 2, n).astype("int32"), "label": (rng.random(n) < 0.3).astype("int32")})
    pdf["score"] = np.where(rng.random(n) < 1 / 3, 0.5, np.round(rng.random(n) + 0.2 * pdf["label"], 4))
    pdf["prediction"] = (pdf["score"] >= 0.6).astype(float)
    return spark.createDataFrame(pdf).repartition(6).cache()


def test_auc_equals_the_exact_evaluator(spark, preds, many_ranges):
    got = {r["fold"]: r["auc"] for r in metrics.auc_roc(preds, ["fold"]).collect()}
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    for fold in (0, 1):
        part = preds.filter(preds.fold == fold)
        assert got[fold] == pytest.approx(evaluator.evaluate(part), abs=1e-12)


def test_auc_does_not_depend_on_partitions(preds, many_ranges):
    one = metrics.auc_roc(preds.repartition(1), ["fold"]).orderBy("fold").collect()
    many = metrics.auc_roc(preds.repartition(13), ["fold"]).orderBy("fold").collect()
    assert [r["auc"] for r in one] == pytest.approx([r["auc"] for r in many], abs=1e-12)


def test_counted_metrics_equal_the_evaluators(preds):
    wide = metrics.fold_metrics(preds, ["fold"]).groupBy("fold").pivot("metric").max("value").collect()
    names = {
        "accuracy": "accuracy",
        "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
        "weighted_f1": "f1",
    }
    for row in wide:
        part = preds.filter(preds.fold == row["fold"]).withColumn("label", preds.label.cast("double"))
        for ours, theirs in names.items():
            want = MulticlassClassificationEvaluator(metricName=theirs).evaluate(part)
            assert row[ours] == pytest.approx(want, abs=1e-12)


def test_single_class_and_never_predicted(spark):
    rows = [("only", 1, 1.0, 0.9), ("only", 1, 1.0, 0.8), ("flat", 1, 0.0, 0.1), ("flat", 0, 0.0, 0.1)]
    df = spark.createDataFrame(rows, "m string, label int, prediction double, score double")
    auc = {r["m"]: r["auc"] for r in metrics.auc_roc(df, ["m"]).collect()}
    assert auc["only"] is None and auc["flat"] == 0.5
    precision = {r["m"]: r["weighted_precision"] for r in metrics.weighted_precision(df, ["m"]).collect()}
    assert precision == {"only": 1.0, "flat": 0.25}
    curve = metrics.roc_curve(df, ["m"]).filter("m = 'only'").collect()
    assert all(r["fpr"] is None for r in curve)


def test_roc_curve_by_brute_force(preds, many_ranges):
    pdf = preds.toPandas()
    curve = metrics.roc_curve(preds, ["fold"]).toPandas()
    assert len(curve) == len(pdf[["fold", "score"]].drop_duplicates())
    for fold, part in pdf.groupby("fold"):
        mine = curve[curve["fold"] == fold].sort_values("threshold", ascending=False)
        for row in mine.iloc[:: max(1, len(mine) // 25)].itertuples():
            above = part[part["score"] >= row.threshold]
            assert row.tp == (above["label"] == 1).sum() and row.fp == (above["label"] == 0).sum()
            assert row.tpr == pytest.approx(row.tp / (part["label"] == 1).sum())


def test_summary_and_scores(spark):
    rows = [("a", f, m, v) for m, vs in {"auc": [0.5, 0.7], "accuracy": [1.0, 0.0]}.items() for f, v in enumerate(vs)]
    table = spark.createDataFrame(rows, "model string, fold int, metric string, value double")
    summary = {r["metric"]: r for r in metrics.cv_summary(table).collect()}
    assert summary["auc"]["std"] == pytest.approx(np.std([0.5, 0.7]))
    scores = metrics.score_dict(table, "a")
    assert scores["auc"]["scores"] == [0.5, 0.7] and scores["accuracy"]["mean"] == 0.5
    with pytest.raises(ValueError):
        metrics.fold_metrics(table, ["model"], ["nonsense"])


def test_best_model_takes_the_first_of_a_tie(spark):
    rows = [(m, 0, "auc", v) for m, v in {"late": 0.8, "early": 0.8, "low": 0.1, "none": None}.items()]
    table = spark.createDataFrame(rows, "model string, fold int, metric string, value double")
    compared = comparison.model_comparison(table, ["low", "early", "late", "none"])
    assert comparison.best_model(compared).first()["model"] == "early"


def test_folds_follow_the_key(spark):
    df = spark.range(3000).selectExpr("if(id % 100 = 0, null, id) as id", "id as row")
    a = {r["row"]: r["fold"] for r in folds.fold_assign(df.repartition(1), 10, "id").collect()}
    b = {r["row"]: r["fold"] for r in folds.fold_assign(df.repartition(8), 10, "id").collect()}
    assert a == b and None not in a.values() and set(a.values()) == set(range(10))
    rows = folds.fold_assign(df, 3, mode="row_id")
    train, test = folds.fold_split(rows, 1)
    assert train.count() + test.count() == 3000
    with pytest.raises(ValueError):
        folds.fold_assign(df, 10)
    with pytest.raises(ValueError):
        folds.fold_assign(df, 1, "id")
