"""One-call forms: predict a test set with an ensemble, or score a classifier by k-fold cross-validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.functions.scores import to_prob_vec
from foldwright.operators.bagging import bagging_predictor
from foldwright.operators.boosting import adaboost_predictor
from foldwright.operators.folds import FitPredict, cross_validate, fold_assign, stage_folds
from foldwright.operators.learners import estimator_predictor
from foldwright.operators.metrics import FOLD_METRICS, fold_metrics, score_dict
from foldwright.staging import stage

ENSEMBLE_METRICS = ["auc", "accuracy", "weighted_f1"]


def _predictions(fit_predict: FitPredict, train: DataFrame, test: DataFrame, key: Sequence[str]) -> DataFrame:
    missing = [c for c in key if c not in test.columns]
    if missing:
        raise ValueError(f"the test rows lack the key column {', '.join(missing)}")
    scored = fit_predict(train, test)
    return scored.select(*key, "label", "prediction", to_prob_vec(F.col("p1")).alias("probability"))


def bagging_predict(
    train: DataFrame,
    test: DataFrame,
    key: Sequence[str] = ("row_id",),
    label: str = "APPROVAL_LABEL",
    features: str = "features",
    num_models: int = 25,
    sample_fraction: float = 1.0,
    max_depth: int = 5,
    seed: int = 42,
) -> DataFrame:
    """``(key, label, prediction, probability)`` of the test rows by a majority of bagged trees."""
    predictor = bagging_predictor(
        num_models, label, features=features, sample_fraction=sample_fraction, max_depth=max_depth, seed=seed
    )
    return _predictions(predictor, train, test, key)


def adaboost_predict(
    train: DataFrame,
    test: DataFrame,
    key: Sequence[str] = ("row_id",),
    label: str = "APPROVAL_LABEL",
    features: str = "features",
    rounds: int = 10,
) -> DataFrame:
    """``(key, label, prediction, probability)`` of the test rows by a weighted vote of boosted learners."""
    return _predictions(adaboost_predictor(label, features, rounds=rounds), train, test, key)


def kfold_scores(
    df: DataFrame,
    model: Estimator | FitPredict,
    k: int = 10,
    key: Sequence[str] | None = None,
    label: str = "APPROVAL_LABEL",
    features: str = "features",
    metrics: Sequence[str] = tuple(FOLD_METRICS),
    parallelism: int = 4,
) -> dict[str, dict]:
    """``{metric: {mean, std, scores}}`` over k folds of an MLlib classifier or a ``fit_predict``.

    Folds follow the key; without one the rows are dealt out by position, and the
    staged table fixes who is where.
    """
    columns = list(dict.fromkeys([*(key or []), label, features]))
    rows = df.select(*columns)
    folded = fold_assign(rows, k, key) if key else fold_assign(rows, k, mode="row_id")
    fit_predict = estimator_predictor(model, label) if isinstance(model, Estimator) else model
    scored = cross_validate(stage_folds(folded), fit_predict, k, parallelism=parallelism, staged=True)
    predictions = stage(scored.select(F.lit("model").alias("model"), *scored.columns), "predictions")
    return score_dict(fold_metrics(predictions, ["model", "fold"], metrics), "model")


def bagging_kfold_scores(
    df: DataFrame,
    k: int = 10,
    key: Sequence[str] | None = None,
    label: str = "APPROVAL_LABEL",
    features: str = "features",
    num_models: int = 25,
    sample_fraction: float = 1.0,
    max_depth: int = 5,
    seed: int = 42,
    parallelism: int = 4,
) -> dict[str, dict]:
    predictor = bagging_predictor(
        num_models, label, features=features, sample_fraction=sample_fraction, max_depth=max_depth, seed=seed
    )
    return kfold_scores(df, predictor, k, key, label, features, ENSEMBLE_METRICS, parallelism)


def adaboost_kfold_scores(
    df: DataFrame,
    k: int = 10,
    key: Sequence[str] | None = None,
    label: str = "APPROVAL_LABEL",
    features: str = "features",
    rounds: int = 10,
    parallelism: int = 4,
) -> dict[str, dict]:
    predictor = adaboost_predictor(label, features, rounds=rounds)
    return kfold_scores(df, predictor, k, key, label, features, ENSEMBLE_METRICS, parallelism)
