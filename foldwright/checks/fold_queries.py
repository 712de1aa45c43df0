"""Queries of what is fitted for all folds, or for all numbers of clusters, in shared passes."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.checks.inputs import SWEEP_STARTS, features, labelled, rounded
from foldwright.operators import fold_logistic as fl
from foldwright.operators import folds, kmeans_sweep, prep
from foldwright.operators.clustering import mark_best_k
from foldwright.operators.fold_prep import fold_prep
from foldwright.plans.features import CATEGORICAL, NUMERIC
from foldwright.staging import stage

K = 10


def folded(spark, d) -> DataFrame:
    """The labelled applicants, staged by fold."""
    rows = labelled(spark, d).select("row_key", *NUMERIC, *CATEGORICAL, F.col("LEARNED_LABEL").cast("double").alias("label"))
    return folds.stage_folds(folds.fold_assign(rows, K, "row_key"))


def by_age(spark, d) -> DataFrame:
    """Applicants with their age as the one feature."""
    point = array_to_vector(F.array(F.col("AGE_AT_APPLICATION").cast("double")))
    rows = labelled(spark, d).select("row_key", F.col("LEARNED_LABEL").cast("double").alias("label"), point.alias("features"))
    return folds.fold_assign(rows, K, "row_key")


def prepared_by_fold(spark, d) -> DataFrame:
    """The applicants with all slots, prepared on all rows, and the columns behind them."""
    rows = folded(spark, d)
    return stage(prep.fit_prep(rows, NUMERIC, CATEGORICAL).transform(rows).drop("features_unscaled"), "prepared-folds")


def fold_prep_slots(spark, d):
    """Slots of the ten training parts with their means and standard deviations."""
    return rounded(fold_prep(folded(spark, d), K, NUMERIC, CATEGORICAL).slots())


def fold_prep_rows(spark, d):
    """Every row prepared by the state that did not see its fold."""
    rows = folded(spark, d)
    ready = fold_prep(rows, K, NUMERIC, CATEGORICAL).transform(rows)
    names = [f"f{i:02d}" for i in range(len(NUMERIC) + 10)]
    return rounded(prep.slot_columns(ready, "features", names, ["row_key", "fold"]))


def _coefficients(spark, models) -> DataFrame:
    rows = [(i, m.intercept, m.coefficients[0]) for i, m in enumerate(models)]
    return rounded(spark.createDataFrame(rows, "fold int, intercept double, slope double"))


def fold_logistic(spark, d):
    """Unregularized fits on the age, all ten in shared passes."""
    return _coefficients(spark, fl.fold_logistic(by_age(spark, d), K, reg=0.0))


def fold_logistic_ridge(spark, d):
    """Fits on the age with a penalty on the squared coefficient of the standardized age."""
    return _coefficients(spark, fl.fold_logistic(by_age(spark, d), K, reg=0.1, mix=0.0))


def fold_logistic_slots(spark, d):
    """At the solution over all slots, expected and observed sums of every slot are the same in each training part."""
    rows = prepared_by_fold(spark, d)
    models = fl.fold_logistic(rows, K, reg=0.0)
    parts = F.explode(F.sequence(F.lit(0), F.lit(K - 1))).alias("part")
    training = rows.withColumnRenamed("fold", "own").select("*", parts).filter("own <> part").withColumnRenamed("part", "fold")
    scored = fl.logistic_predictions(training, models, [*NUMERIC, *CATEGORICAL])
    sums = [F.struct(F.lit(c).alias("slot"), (F.col("p1") * F.col(c)).alias("x")) for c in NUMERIC]
    sums += [F.struct(F.concat(F.lit(f"{c}_VEC_"), F.col(c)).alias("slot"), F.col("p1").alias("x")) for c in CATEGORICAL]
    long = scored.select("fold", F.inline(F.array(*sums)))
    return rounded(long.groupBy("fold", "slot").agg(F.count("*").alias("n"), F.sum("x").alias("expected")), 2)


def fold_adaboost(spark, d):
    """Three rounds on the age in each training part: errors and learner weights."""
    fitted = fl.fold_adaboost(by_age(spark, d), K, rounds=3)
    rows = [(i, t, r.err, r.alpha) for i, rounds in enumerate(fitted) for t, r in enumerate(rounds)]
    return rounded(spark.createDataFrame(rows, "fold int, round int, err double, alpha double"))


def fold_adaboost_weights(spark, d):
    """Ten rounds over all slots, the rows weighted again from the learners alone: after a round the missed ones hold half."""
    rows = prepared_by_fold(spark, d).select("fold", "label", "features")
    fitted = fl.fold_adaboost(rows, K, rounds=10)
    table = spark.createDataFrame(
        [(i, t, r.learner.intercept, list(r.learner.coefficients), r.alpha) for i, rs in enumerate(fitted) for t, r in enumerate(rs)],
        "part int, round int, intercept double, coefficients array<double>, alpha double",
    )
    learners = table.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("round", "intercept", "coefficients", "alpha"))).alias("learners"))
    x = vector_to_array("features")

    def misses(m):
        products = F.zip_with(m["coefficients"], x, lambda a, b: a * b)
        positive = m["intercept"] + F.aggregate(products, F.lit(0.0), lambda held, v: held + v) > 0
        return (positive != (F.col("label") > 0.5)).cast("int")

    parts = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(K - 1)))).filter("fold <> part")
    missed = parts.join(F.broadcast(learners), "part").withColumn("missed", F.transform("learners", misses))
    grown = F.transform(
        F.arrays_zip("learners", "missed"), lambda z: F.exp(z["learners"]["alpha"] * (F.lit(2.0) * z["missed"] - F.lit(1.0)))
    )
    upto = F.transform(
        "missed",
        lambda m, t: F.struct(
            t.alias("round"),
            m.alias("missed"),
            F.aggregate(F.slice(F.col("grown"), F.lit(1), t + 1), F.lit(1.0), lambda held, v: held * v).alias("w"),
        ),
    )
    long = missed.withColumn("grown", grown).select("part", F.inline(upto))
    share = F.sum(F.col("w") * F.col("missed")) / F.sum("w")
    return rounded(long.groupBy(F.col("part").alias("fold"), "round").agg(F.count("*").alias("n"), share.alias("missed")))


def _places(spark, d) -> DataFrame:
    point = F.array(F.col("AGE_AT_APPLICATION").cast("double"), F.col("APPLICANT_FAMILY_COUNT").cast("double"))
    return kmeans_sweep.points_of(features(spark, d).select(point.alias("features")))


def kmeans_steps(spark, d):
    """Three steps of all k from given centers, and the points that are then nearest to each."""
    points = _places(spark, d)
    centers = kmeans_sweep.lloyd(points, SWEEP_STARTS, max_iter=3)
    sums = kmeans_sweep.cluster_sums(points, centers)
    rows = [(k, i, int(sums[k][i, 0]), float(c[0]), float(c[1])) for k, held in centers.items() for i, c in enumerate(held)]
    return rounded(spark.createDataFrame(rows, "k int, cluster int, n bigint, age double, family double"))


def kmeans_sweep_choice(spark, d):
    """Silhouettes of all k after three steps, and the k they choose."""
    points = _places(spark, d)
    scores = kmeans_sweep.silhouettes(points, kmeans_sweep.lloyd(points, SWEEP_STARTS, max_iter=3))
    return rounded(mark_best_k(stage(scores, "silhouettes")))


QUERIES = {
    f.__name__: f
    for f in (
        fold_prep_slots,
        fold_prep_rows,
        fold_logistic,
        fold_logistic_ridge,
        fold_logistic_slots,
        fold_adaboost,
        fold_adaboost_weights,
        kmeans_steps,
        kmeans_sweep_choice,
    )
}
