"""Boosting: weighted errors, learner weights, row weights and the weighted vote.

The row weights are never stored. A row's weight after any round is a product of
scalars and of its own predictions so far, so each round computes it in one
projection over the unchanged training table. There is no per-round join, write or
checkpoint, and a lost executor costs only its own tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.functions.scores import exp_sigmoid, threshold_predict
from foldwright.operators.bagging import sum_of_all
from foldwright.operators.learners import only_prediction, weak_learner_fit

EPS = 1e-10


def missed(label: str = "label", prediction: str = "prediction") -> Column:
    """1.0 where the predicted class is wrong, else 0.0."""
    return (F.col(prediction).cast("int") != F.col(label).cast("int")).cast("double")


def weighted_error(df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str = "w") -> DataFrame:
    """One row ``(err, total)``: the weight of the misclassified rows, and of all rows."""
    w = F.col(weight)
    return df.agg(F.sum(w * missed(label, prediction)).alias("err"), F.sum(w).alias("total"))


def boost_alpha(err: float, eps: float = EPS) -> float:
    """Weight of a learner; negative above an error of one half, which turns its vote around."""
    held = min(max(err, eps), 1.0 - eps)
    return 0.5 * math.log((1.0 - held) / held)


def weight_total(alpha: float, err: float, total: float = 1.0) -> float:
    """Sum of the row weights after an update: the missed part grows by e^alpha, the rest shrinks by it.

    This needs no second pass, also when the error was clamped.
    """
    return err * math.exp(alpha) + (total - err) * math.exp(-alpha)


def boost_reweight(
    df: DataFrame,
    alpha: float,
    err: float,
    total: float = 1.0,
    label: str = "label",
    prediction: str = "prediction",
    weight: str = "w",
) -> DataFrame:
    """Raise the weight of missed rows, lower that of the rest, and scale to a sum of 1."""
    grown = F.col(weight) * F.exp(F.lit(alpha) * (2.0 * missed(label, prediction) - 1.0))
    return df.withColumn(weight, grown / F.lit(weight_total(alpha, err, total)))


@dataclass(frozen=True)
class Round:
    learner: object
    err: float
    alpha: float


def boost(
    train: DataFrame,
    fit: Callable[[DataFrame, int], object],
    predict: Callable[[object, DataFrame], DataFrame],
    rounds: int,
    label: str = "label",
    early_stop: bool = False,
) -> list[Round]:
    """Fit ``rounds`` learners in turn, each on the weights the ones before it left.

    ``fit(weighted, t)`` returns a learner; ``predict(learner, df)`` adds its
    ``prediction``. Each round costs the fit and one aggregate. ``early_stop`` ends
    before a learner that is no better than chance.
    """
    columns = train.columns
    n = train.count()
    if n == 0:
        raise ValueError("boosting needs at least one row")
    weighted = train.withColumn("w", F.lit(1.0 / n))
    done: list[Round] = []
    for t in range(rounds):
        learner = fit(weighted, t)
        scored = predict(learner, weighted)
        row = weighted_error(scored, label).first()
        err, total = float(row["err"]), float(row["total"])
        if early_stop and err >= 0.5:
            break
        alpha = boost_alpha(err)
        done.append(Round(learner, err, alpha))
        weighted = boost_reweight(scored, alpha, err, total, label).select(*columns, "w")
    return done


def adaboost_fit(
    train: DataFrame,
    rounds: int = 10,
    early_stop: bool = False,
    label: str = "label",
    features: str = "features",
    max_iter: int = 50,
) -> list[Round]:
    """Boost unregularized logistic regressions."""
    table = train.select(F.col(label).cast("double").alias("label"), F.col(features).alias("features"))

    def fit(weighted: DataFrame, _: int):
        return only_prediction(weak_learner_fit(weighted, max_iter=max_iter), "prediction")

    return boost(table, fit, lambda model, df: model.transform(df), rounds, early_stop=early_stop)


def weighted_vote(df: DataFrame, votes: Sequence[tuple[str, float]]) -> DataFrame:
    """Add ``margin`` (sum of alpha times the vote as -1 or 1), ``p1`` and ``prediction`` from 0/1 vote columns."""
    margin = reduce(add, [F.lit(float(alpha)) * (F.col(v).cast("int") * 2 - 1) for v, alpha in votes], F.lit(0.0))
    scored = df.withColumn("margin", margin)
    scored = scored.withColumn("p1", exp_sigmoid(F.col("margin")))
    return scored.withColumn("prediction", threshold_predict(F.col("p1")))


def score_join(base: DataFrame, frames: Sequence[tuple[DataFrame, float]], key: Sequence[str]) -> DataFrame:
    """``base`` with ``margin`` from one ``(key, vote)`` table and alpha per learner, for votes made apart.

    A row of ``base`` is kept when every table has its key exactly once; null keys
    meet nothing. The tables are summed first, so that one join remains.
    """
    signed = [f.select(*key, (F.lit(float(a)) * (F.col("vote").cast("int") * 2 - 1)).alias("_part")) for f, a in frames]
    return base.join(sum_of_all(signed, key, "margin"), list(key), "inner")


def adaboost_votes(df: DataFrame, rounds: Sequence[Round]) -> tuple[DataFrame, list[tuple[str, float]]]:
    """Add each learner's class as a column; returns the columns with their alphas."""
    votes = []
    for i, done in enumerate(rounds):
        name = f"vote_{i}"
        df = only_prediction(done.learner, name).transform(df)
        votes.append((name, done.alpha))
    return df, votes


def adaboost_predictor(label: str = "label", features: str = "features", **settings):
    """A ``fit_predict`` of the whole ensemble."""

    def fit_predict(train: DataFrame, test: DataFrame) -> DataFrame:
        rounds = adaboost_fit(train, label=label, features=features, **settings)
        named = test if features == "features" else test.withColumn("features", F.col(features))
        voted, votes = adaboost_votes(named, rounds)
        scored = weighted_vote(voted, votes).drop(*[name for name, _ in votes])
        return scored.withColumns({"label": F.col(label).cast("double"), "score": F.col("p1")})

    return fit_predict
