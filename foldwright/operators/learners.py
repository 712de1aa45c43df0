"""MLlib learners with the settings of the study, and their predictions as plain columns."""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import HasTrainingSummary
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.staging import shared_dir


def without_summary(model: Model) -> Model:
    """Drop the training summaries of a fitted model, and of the models that it is made of.

    A summary of two classes holds the session, which then goes out with every task that scores rows. From the
    first ``observe`` on a session cannot be serialized, so that no such model could score any more.
    """
    if isinstance(model, HasTrainingSummary) and model.hasSummary:
        context = SparkContext._active_spark_context
        model._java_obj.setSummary(context._jvm.scala.Option.empty())
    parts = [*getattr(model, "stages", []), *getattr(model, "models", []), getattr(model, "bestModel", None)]
    for part in parts:
        if isinstance(part, Model):
            without_summary(part)
    return model


def tree_fit(
    train: DataFrame,
    label: str = "label",
    features: str = "features",
    max_depth: int = 5,
    seed: int = 42,
    weight: str | None = None,
) -> DecisionTreeClassificationModel:
    tree = DecisionTreeClassifier(labelCol=label, featuresCol=features, maxDepth=max_depth, seed=seed)
    if weight is not None:
        tree = tree.setWeightCol(weight)
    return tree.fit(train)


def logreg(
    label: str = "label", features: str = "features", max_iter: int = 100, reg: float = 0.01, mix: float = 0.5
) -> LogisticRegression:
    return LogisticRegression(
        labelCol=label, featuresCol=features, maxIter=max_iter, regParam=reg, elasticNetParam=mix
    )


def logreg_fit(train: DataFrame, **settings) -> LogisticRegressionModel:
    """Elastic-net logistic regression, without its training summary."""
    return without_summary(logreg(**settings).fit(train))


def weak_learner_fit(
    train: DataFrame, label: str = "label", features: str = "features", weight: str = "w", max_iter: int = 50
) -> LogisticRegressionModel:
    """Unregularized logistic regression on weighted rows, without its training summary."""
    learner = LogisticRegression(
        labelCol=label, featuresCol=features, weightCol=weight, maxIter=max_iter, regParam=0.0
    )
    return without_summary(learner.fit(train))


def gbt_fit(
    train: DataFrame,
    label: str = "label",
    features: str = "features",
    max_iter: int = 50,
    max_depth: int = 5,
    step: float = 0.1,
    seed: int = 42,
) -> GBTClassificationModel:
    """Gradient-boosted trees. With a checkpoint folder set, MLlib cuts its lineage every ten trees."""
    shared_dir(train.sparkSession)
    learner = GBTClassifier(
        labelCol=label, featuresCol=features, maxIter=max_iter, maxDepth=max_depth, stepSize=step, seed=seed
    )
    return learner.fit(train)


def only_prediction(model: Model, out: str) -> Model:
    """Let the model write nothing but its predicted class, under the name ``out``."""
    return model.setPredictionCol(out).setRawPredictionCol("").setProbabilityCol("")


def standardizes(estimator: Estimator) -> bool:
    """Whether a fit on plain slots is the one on slots that the same rows have standardized.

    MLlib's logistic regression centers and scales its training rows itself, and a slot that is constant there
    gets no coefficient. Weights would count in its scales, and bounds would hold for other slots.
    """
    if not isinstance(estimator, LogisticRegression) or not (estimator.getStandardization() and estimator.getFitIntercept()):
        return False
    given = {p.name for p in estimator.params if estimator.isSet(p)}
    bound = any(name.startswith(("lowerBounds", "upperBounds")) for name in given)
    return estimator.getFeaturesCol() == "features" and "weightCol" not in given and not bound


def estimator_predictor(estimator: Estimator, label: str = "label"):
    """A ``fit_predict`` for any MLlib classifier; rows are ranked by its raw score of class 1.

    ``standardizes`` and ``label`` tell ``cross_validate`` which columns of a preparation it needs.
    """

    def fit_predict(train: DataFrame, test: DataFrame) -> DataFrame:
        scored = without_summary(estimator.fit(train)).transform(test)
        raw = F.get(vector_to_array("rawPrediction"), F.lit(1))
        p1 = F.get(vector_to_array("probability"), F.lit(1)) if "probability" in scored.columns else raw
        return scored.withColumns({"label": F.col(label).cast("double"), "p1": p1, "score": raw})

    fit_predict.standardizes, fit_predict.label = standardizes(estimator), label
    return fit_predict
