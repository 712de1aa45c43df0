"""Fits of all folds, or of all numbers of clusters, in shared passes; quartiles from brackets."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from foldwright.operators import boosting, fold_logistic, folds, kmeans_sweep, learners, prep, quantiles
from foldwright.operators.fold_prep import fold_prep, fold_summaries
from foldwright.operators.metrics import fold_metrics
from foldwright.plans import Settings, model_study
from foldwright.staging import stage

K = 4


# -- preparation ----------------------------------------------------------------------


def mixed_rows(spark):
    """Categories that one fold alone has, null and frequent ones; missing, constant and shifted numbers."""
    n = F.col("id")
    return spark.range(400, numPartitions=5).select(
        n.alias("key"),
        (n % K).cast("int").alias("fold"),
        F.when(n % 13 != 0, F.lit(1e6) + F.sin(n)).alias("a"),
        F.lit(7).alias("b"),
        F.when(n % 17 == 0, None).when(n == 5, "only in fold 1").when(n % 3 == 0, "x").otherwise(F.concat(F.lit("v"), n % 7)).alias("c"),
        (n % 5).cast("int").alias("d"),
    )


def test_prep_of_each_training_part_equals_its_own_fit(spark):
    rows = stage(mixed_rows(spark), "mixed")
    state = fold_prep(rows, K, ["a", "b"], ["c", "d"])
    x = vector_to_array("features")
    for i in range(K):
        train, test = folds.fold_split(rows, i)
        fitted = prep.fit_prep(train, ["a", "b"], ["c", "d"])
        for part, own in ((test, state.transform(test)), (train, state.transform(train, i))):
            expected = {r["key"]: r["x"] for r in fitted.transform(part).select("key", x.alias("x")).collect()}
            got = {r["key"]: r["x"] for r in own.select("key", x.alias("x")).collect()}
            assert got.keys() == expected.keys()
            assert all(np.allclose(got[k], expected[k], atol=1e-9) for k in got)
        names = [r["name"] for r in state.slots().filter(F.col("part") == i).orderBy("slot").collect()]
        assert names == prep.feature_names(fitted.transform(train))


def test_prep_is_one_scan_and_joins_by_hash(spark):
    rows = stage(mixed_rows(spark), "mixed")
    plan = fold_summaries(rows, ["a", "b"], ["c", "d"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    state = fold_prep(rows, K, ["a"], ["c"])
    for df in (state.transform(rows), state.transform(rows, 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Python" not in plan


def test_prep_of_odd_tables(spark):
    rows = mixed_rows(spark)
    nothing = fold_prep(stage(rows.limit(0), "none"), K, ["a"], ["c"])
    assert nothing.slots().count() == 0 and nothing.transform(rows).count() == 0
    one = fold_prep(stage(rows.filter("fold = 0"), "one"), K, ["a"], ["c"])
    assert one.slots().filter("part = 0").count() == 0
    assert one.slots().filter("part = 1 and slot = 0").first()["std"] > 0
    # A number that is missing in all rows leaves no row.
    gone = fold_prep(rows.withColumn("a", F.lit(None).cast("double")), K, ["a"], ["d"])
    assert gone.transform(rows.withColumn("a", F.lit(None).cast("double"))).count() == 0
    with pytest.raises(ValueError):
        fold_prep(rows, 1, ["a"], ["c"])


# -- logistic fits --------------------------------------------------------------------


@pytest.fixture(scope="module")
def points(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(600, 3)) * [1.0, 40.0, 0.2] + [0.0, 2000.0, -3.0]
    group = draw.integers(0, 3, 600)
    y = (x[:, 0] + (x[:, 1] - 2000) / 50 + (group == 1) + draw.normal(size=600) > 0.3).astype(float)
    rows = [(i, int(i % K), float(y[i]), [*map(float, x[i]), *(float(group[i] == g) for g in range(3)), 4.0]) for i in range(600)]
    df = spark.createDataFrame(rows, "key int, fold int, label double, x array<double>")
    return stage(df.repartition(5).withColumn("features", array_to_vector("x")), "points")


@pytest.mark.parametrize("reg,mix", [(0.0, 0.0), (0.01, 0.5), (0.1, 0.0), (0.05, 1.0), (10.0, 1.0)])
def test_fold_logistic_equals_single_fits(points, reg, mix):
    models = fold_logistic.fold_logistic(points, K, reg, mix)
    for i in (3,):
        single = LogisticRegression(maxIter=3000, tol=1e-15, regParam=reg, elasticNetParam=mix).fit(points.filter(F.col("fold") != i))
        assert np.allclose(models[i].coefficients, single.coefficients.toArray(), atol=1e-6)
        assert models[i].intercept == pytest.approx(single.intercept, abs=1e-4)
        assert models[i].coefficients[-1] == 0.0


def test_fold_logistic_predictions(points):
    models = fold_logistic.fold_logistic(points, K)
    got = fold_logistic.logistic_predictions(points, models, ["key"])
    learner = LogisticRegression(maxIter=3000, tol=1e-15, regParam=0.01, elasticNetParam=0.5)
    expected = folds.cross_validate(points, learners.estimator_predictor(learner), K, ["key"], staged=True)
    both = got.join(expected.select("key", F.col("p1").alias("q"), F.col("prediction").alias("r"), F.col("fold").alias("f")), "key")
    assert both.count() == 600
    assert both.filter((F.abs(F.col("p1") - F.col("q")) > 1e-6) | (F.col("prediction") != F.col("r")) | (F.col("f") != F.col("fold"))).isEmpty()
    assert got.columns == ["fold", "key", *folds.SCORED]


def test_fold_logistic_of_odd_tables(spark, points):
    certain = fold_logistic.fold_logistic(points.withColumn("label", F.lit(1.0)), K)
    assert all(m.intercept == math.inf and not any(m.coefficients) for m in certain)
    scored = fold_logistic.logistic_predictions(points.withColumn("label", F.lit(1.0)), certain)
    assert scored.filter("p1 = 1.0 and prediction = 1.0").count() == 600
    # Classes that a slot separates have no finite solution; the steps end.
    apart = points.withColumn("features", array_to_vector(F.array(F.col("label") * 2 - 1 + F.get("x", F.lit(0)) / 1000)))
    far = fold_logistic.fold_logistic(apart, K, reg=0.0, max_iter=20)
    assert fold_logistic.logistic_predictions(apart, far).filter("prediction <> label").isEmpty()
    with pytest.raises(ValueError, match="at least one row"):
        fold_logistic.fold_logistic(points.limit(0), K)
    with pytest.raises(ValueError, match="fold 2"):
        fold_logistic.fold_logistic(points.filter("fold = 2"), K)
    wide = spark.range(20).select((F.col("id") % 2).cast("int").alias("fold"), F.lit(1.0).alias("label"), array_to_vector(F.array_repeat(F.lit(1.0), 600)).alias("features"))
    with pytest.raises(ValueError, match="600 slots"):
        fold_logistic.fold_logistic(wide, 2)


# -- boosting -------------------------------------------------------------------------


@pytest.mark.parametrize("early_stop", [False, True])
def test_fold_adaboost_equals_boosting_of_each_part(points, early_stop):
    fitted = fold_logistic.fold_adaboost(points, K, 6, early_stop)
    for i in (1, 2):
        single = boosting.adaboost_fit(points.filter(F.col("fold") != i), 6, early_stop, max_iter=500)
        assert len(fitted[i]) == len(single)
        # The single fits stop earlier; their errors differ by a few rows' weight at most.
        assert [r.err for r in fitted[i]][:2] == pytest.approx([r.err for r in single][:2], abs=0.02)


def test_fold_adaboost_halves_the_weights(points):
    """After a round the rows that its learner misses hold half of the weight."""
    fitted = fold_logistic.fold_adaboost(points, K, 5)
    rows = points.select("fold", "label", "x").toPandas()
    for i in range(K):
        part = rows[rows["fold"] != i]
        x, y = np.stack(part["x"]), part["label"].to_numpy() > 0.5
        w = np.full(len(y), 1.0 / len(y))
        for r in fitted[i]:
            missed = (x @ np.array(r.learner.coefficients) + r.learner.intercept > 0) != y
            assert w[missed].sum() == pytest.approx(r.err, abs=1e-9)
            p = 1 / (1 + np.exp(-(x @ np.array(r.learner.coefficients) + r.learner.intercept)))
            assert np.abs(x.T @ (w * (p - y))).max() < 1e-6 * np.abs(x).max()
            w = w * np.exp(np.where(missed, r.alpha, -r.alpha))
            w /= w.sum()
            assert w[missed].sum() == pytest.approx(0.5, abs=1e-9)


def test_fold_adaboost_predictions(points):
    fitted = fold_logistic.fold_adaboost(points, K, 3)
    got = fold_logistic.adaboost_predictions(points, fitted, ["key", "x"]).toPandas()
    for _, row in got.iterrows():
        margin = sum(r.alpha * (1 if np.dot(r.learner.coefficients, row["x"]) + r.learner.intercept > 0 else -1) for r in fitted[row["fold"]])
        assert row["p1"] == pytest.approx(1 / (1 + math.exp(-margin)))
        assert row["prediction"] == float(row["p1"] >= 0.5)
    certain = fold_logistic.fold_adaboost(points.withColumn("label", F.lit(0.0)), K, 3)
    assert all(r.err == 0.0 for rounds in certain for r in rounds)


def test_study_options(spark, points):
    """Leak-free preparation, one tree a bootstrap, other depths and seeds."""
    rows = points.select(
        F.col("key").alias("row_key"),
        "label",
        "features",
        F.get("x", F.lit(0)).alias("AGE_AT_APPLICATION"),
        F.get("x", F.lit(1)).alias("APPLICANT_FAMILY_COUNT"),
        F.get("x", F.lit(2)).alias("APPLICATION_YEAR"),
        F.when(F.get("x", F.lit(3)) > 0, "a").otherwise("b").alias("MARITAL_STATUS"),
        F.lit("same").alias("GENDER_DESC"),
    )
    base = {"label": "label", "k": 3, "num_models": 2, "rounds": 2}
    for change in ({"fit_scope": "fold"}, {"bagging": "separate", "tree_depth": 2, "seed": 7}, {"early_stop": True}):
        tables = model_study(rows, Settings(**base, **change))
        assert tables["comparison"].count() == 3
        assert tables["comparison"].filter("accuracy_mean < 0.7").isEmpty()


def test_wide_vectors_are_fitted_one_by_one(points, monkeypatch):
    from foldwright.plans import study

    monkeypatch.setattr(study, "GRAM_SLOTS", 3)
    settings = Settings(key=("key",), label="label", k=K, rounds=2, parallelism=4)
    found = fold_metrics(study.cross_validated(points, settings, [study.LOGISTIC, study.ADABOOST]), ["model", "fold"])
    assert found.filter("metric = 'accuracy' and value > 0.6").count() == 2 * K


# -- clusters -------------------------------------------------------------------------


def plain_lloyd(x, centers, steps):
    centers = np.array(centers, dtype=float)
    for _ in range(steps):
        near = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        centers = np.array([x[near == c].mean(axis=0) if (near == c).any() else centers[c] for c in range(len(centers))])
    return centers


def test_sweep_equals_plain_steps(spark):
    draw = np.random.default_rng(8)
    x = np.concatenate([draw.normal(c, 0.4, size=(60, 2)) for c in ((0, 0), (4, 4), (0, 5))])
    df = spark.createDataFrame([(list(map(float, p)),) for p in x] + [(None,)], "features array<double>").repartition(4)
    held = kmeans_sweep.points_of(df)
    starts = {2: x[:2], 3: x[[0, 60, 120]], 4: np.array([[0, 0], [4, 4], [0, 5], [900, 900]])}
    for steps in (1, 4):
        found = kmeans_sweep.lloyd(held, starts, steps)
        for k, start in starts.items():
            assert np.allclose(found[k], plain_lloyd(x, start, steps))
    # The silhouettes are those of the library's evaluator.
    from foldwright.operators import clustering

    centers = kmeans_sweep.lloyd(held, starts)
    scores = {r["k"]: r["silhouette"] for r in kmeans_sweep.silhouettes(held, centers).collect()}
    for k, c in centers.items():
        assigned = clustering.nearest_center(df.filter("features is not null"), c.tolist(), "features")
        assert scores[k] == pytest.approx(clustering.silhouette(assigned))


def test_start_centers_do_not_depend_on_the_partitions(spark):
    points = spark.range(5000).select(F.array((F.col("id") % 50).cast("double"), (F.col("id") % 7).cast("double")).alias("x"))
    found = [kmeans_sweep.start_centers(points.repartition(n), [2, 5]) for n in (1, 6)]
    assert all((found[0][k] == found[1][k]).all() for k in (2, 5))
    assert (found[0][5][:2] == found[0][2]).all()
    # One heavy point that the hash does not draw, and fewer points than clusters.
    heavy = spark.range(5000).select(F.array(F.lit(3.0)).alias("x"))
    assert kmeans_sweep.start_centers(heavy, [2])[2].tolist() == [[3.0]]
    with pytest.raises(ValueError):
        kmeans_sweep.start_centers(points.limit(0), [2])


# -- quartiles ------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["double", "int", "heavy", "beyond"])
def test_quartiles_from_brackets(spark, monkeypatch, kind):
    monkeypatch.setattr(quantiles, "ACCURACY", 50)
    monkeypatch.setattr(quantiles, "SMALL_GROUP", 200)
    draw = np.random.default_rng(3)
    values = {
        "double": draw.normal(size=5000),
        "int": draw.integers(-500, 500, 5000),
        "heavy": np.where(draw.random(5000) < 0.6, 7.0, draw.normal(size=5000)),
        "beyond": 2**60 + draw.integers(0, 90, 5000),
    }[kind]
    whole = kind in ("int", "beyond")
    group = [None if g == 3 else f"g{g}" for g in draw.choice(5, 5000, p=[0.5, 0.3, 0.1, 0.09, 0.01])]
    rows = [(g, int(v) if whole else float(v)) for g, v in zip(group, values)] + [("g0", None), ("none", None)]
    df = stage(spark.createDataFrame(rows, f"g string, v {'bigint' if whole else 'double'}").repartition(6), "values")
    got = {r["g"]: r for r in quantiles.quartiles(df, ["g"], "v").collect()}
    assert "none" not in got
    for g in set(group):
        own = np.sort(np.array([v for h, v in zip(group, values) if h == g]))
        assert got[g]["n"] == len(own)
        for name, p in quantiles.QUARTILES.items():
            rank = (len(own) - 1) * p
            lo, hi = own[math.floor(rank)], own[math.ceil(rank)]
            assert got[g][name] == pytest.approx(float(lo + (hi - lo) * (rank - math.floor(rank))), rel=1e-15 if kind != "double" else 1e-9)


def test_quartiles_move_few_rows(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SMALL_GROUP", 1000)
    df = stage(spark.range(200_000).select((F.col("id") % 2).alias("g"), F.rand(1).alias("v")), "values")
    found = quantiles.boxplot_stats(df, ["g"], "v")
    assert "rangepartitioning" not in found._jdf.queryExecution().executedPlan().toString()
    values = df.select("g", F.col("v").alias("_value"))
    brackets = stage(quantiles._brackets(values, ["g"]), "brackets")
    kept = quantiles._counted(values, brackets, ["g"])
    assert kept.count() < 0.03 * 200_000
    assert "rangepartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
