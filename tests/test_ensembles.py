import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from foldwright.functions import poisson_cuts
from foldwright.operators import bagging, boosting, folds, learners
from foldwright.operators.importance import feature_importance
from foldwright.plans import adaboost_predict, bagging_kfold_scores, bagging_predict, kfold_scores


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    n = 1500
    x = rng.normal(size=(n, 3))
    label = ((x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(scale=0.7, size=n)) > 0.4).astype(float)
    pdf = pd.DataFrame({"row_id": np.arange(n), "label": label, "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]})
    df = spark.createDataFrame(pdf).withColumn("features", array_to_vector(F.array("a", "b", "c")))
    return df.repartition(4).cache()


def test_poisson_cuts_follow_the_distribution():
    for rate in (0.5, 1.0, 3.0):
        cuts = np.array(poisson_cuts(rate)) / 2**32
        want = np.cumsum([math.exp(-rate) * rate**n / math.factorial(n) for n in range(len(cuts))])
        assert np.abs(cuts - want).max() < 1e-9
    with pytest.raises(ValueError):
        poisson_cuts(0)


def test_bootstrap_is_stable_and_of_the_right_size(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = bagging.bootstrap_sample(df.repartition(1), "k", 2).orderBy("k").collect()
    b = bagging.bootstrap_sample(df.repartition(7), "k", 2).orderBy("k").collect()
    assert a == b
    weights = np.array([r["w"] for r in a])
    assert weights.sum() / 20000 == pytest.approx(1.0, abs=0.03)
    assert len(weights) / 20000 == pytest.approx(1 - math.exp(-1), abs=0.02)
    other = bagging.bootstrap_sample(df, "k", 3).orderBy("k").collect()
    assert a != other


def test_votes_of_the_forest_and_of_separate_trees(rows):
    for strategy in ("forest", "separate"):
        trees = bagging.bagging_fit(rows, 5, max_depth=3, strategy=strategy, key="row_id")
        voted, votes = bagging.cast_votes(rows, trees)
        scored = bagging.majority_vote(voted, votes)
        shares = {r["p1"] for r in scored.select("p1").distinct().collect()}
        assert shares <= {i / 5 for i in range(6)}
        assert scored.filter(F.col("prediction") == F.col("label")).count() / rows.count() > 0.7
        plan = scored.select("row_id", "p1")._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Python" not in plan
    with pytest.raises(ValueError):
        bagging.bagging_fit(rows, strategy="separate")
    with pytest.raises(ValueError):
        bagging.bagging_fit(rows, strategy="other")


def test_chained_votes_equal_joined_votes(rows):
    trees = bagging.bagging_fit(rows, 4, max_depth=2)
    voted, votes = bagging.cast_votes(rows, trees)
    chained = bagging.majority_vote(voted, votes).select("row_id", "p1")
    apart = [
        learners.only_prediction(t, "p").transform(rows).select("row_id", F.col("p").cast("int").alias("vote"))
        for t in trees
    ]
    joined = bagging.vote_join(apart, ["row_id"]).select("row_id", "p1")
    assert chained.exceptAll(joined).count() == 0 and joined.count() == rows.count()


def test_vote_join_keeps_keys_of_all_tables(spark):
    a = spark.createDataFrame([(1, 1), (2, 0)], "k int, vote int")
    b = spark.createDataFrame([(1, 0), (3, 1)], "k int, vote int")
    assert [tuple(r) for r in bagging.vote_join([a, b], ["k"]).collect()] == [(1, 1, 0.5)]
    base = spark.createDataFrame([(1, "x"), (2, "y")], "k int, name string")
    got = boosting.score_join(base, [(a, 0.5), (b, 0.25)], ["k"]).collect()
    assert [(r["k"], r["margin"]) for r in got] == [(1, 0.25)]


def test_vote_join_leaves_out_repeated_and_null_keys(spark):
    a = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1)], "k int, vote int")
    b = spark.createDataFrame([(2, 1), (None, 0)], "k int, vote int")
    assert [tuple(r) for r in bagging.vote_join([a, b], ["k"]).collect()] == [(2, 1, 0.5)]
    base = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert [r["k"] for r in boosting.score_join(base, [(a, 1.0), (b, 1.0)], ["k"]).collect()] == [2]
    many = [spark.createDataFrame([(1, 1), (2, i % 2)] + [(3, 1)] * (i != 64), "k int, vote int") for i in range(65)]
    assert sorted(tuple(r)[:2] for r in bagging.vote_join(many, ["k"]).collect()) == [(1, 65), (2, 32)]


def test_tie_is_positive(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "v0 int, v1 int")
    got = bagging.majority_vote(df, ["v0", "v1"], vector=True).select("p1", "prediction", vector_to_array("probability"))
    assert [tuple(r) for r in got.collect()] == [(0.5, 1.0, [0.5, 0.5]), (0.0, 0.0, [1.0, 0.0])]


def test_boosting_leaves_half_the_weight_on_misses(rows):
    fitted = boosting.adaboost_fit(rows, rounds=3)
    assert len(fitted) == 3
    weighted = rows.withColumn("w", F.lit(1.0 / rows.count()))
    for done in fitted:
        scored = learners.only_prediction(done.learner, "prediction").transform(weighted)
        row = boosting.weighted_error(scored).first()
        assert row["err"] == pytest.approx(done.err) and row["total"] == pytest.approx(1.0)
        updated = boosting.boost_reweight(scored, done.alpha, row["err"], row["total"])
        after = boosting.weighted_error(updated).first()
        assert after["err"] == pytest.approx(0.5, abs=1e-9) and after["total"] == pytest.approx(1.0)
        weighted = updated.select("row_id", "label", "features", "w")


def test_boosting_matches_a_plain_loop(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.integers(0, 2, (400, 4)), columns=["label", "v0", "v1", "v2"])
    pdf["v0"] = np.where(rng.random(400) < 0.8, 1 - pdf["label"], pdf["v0"])
    rounds = boosting.boost(
        spark.createDataFrame(pdf),
        fit=lambda weighted, t: f"v{t}",
        predict=lambda rule, df: df.withColumn("prediction", F.col(rule)),
        rounds=3,
    )
    w = np.full(400, 1 / 400)
    for t, done in enumerate(rounds):
        missed = (pdf[f"v{t}"] != pdf["label"]).to_numpy()
        err = w[missed].sum()
        alpha = 0.5 * math.log((1 - err) / err)
        assert (done.err, done.alpha) == (pytest.approx(err), pytest.approx(alpha))
        w = w * np.exp(alpha * np.where(missed, 1, -1))
        w /= w.sum()
    assert rounds[0].alpha < 0


def test_clamped_error_and_early_stop(spark):
    assert boosting.boost_alpha(0.0) == pytest.approx(0.5 * math.log((1 - 1e-10) / 1e-10))
    assert boosting.boost_alpha(1.0) == pytest.approx(-boosting.boost_alpha(0.0))
    df = spark.createDataFrame([(1, 1, 0), (0, 0, 1)], "label int, right int, wrong int").withColumn("w", F.lit(0.5))
    for rule in ("right", "wrong"):
        err = boosting.weighted_error(df, prediction=rule).first()["err"]
        updated = boosting.boost_reweight(df, boosting.boost_alpha(err), err, prediction=rule)
        assert updated.agg(F.sum("w")).first()[0] == pytest.approx(1.0)
    rounds = boosting.boost(
        df.drop("w"),
        fit=lambda weighted, t: "wrong",
        predict=lambda rule, d: d.withColumn("prediction", F.col(rule)),
        rounds=3,
        early_stop=True,
    )
    assert rounds == []
    with pytest.raises(ValueError):
        boosting.boost(df.filter("label > 5"), None, None, 1)


def test_boosting_plan_does_not_grow_joins_or_shuffles(rows):
    fitted = boosting.adaboost_fit(rows, rounds=3)
    voted, votes = boosting.adaboost_votes(rows, fitted)
    scored = boosting.weighted_vote(voted, votes).select("row_id", "p1", "prediction")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan
    p1 = scored.agg(F.min("p1"), F.max("p1")).first()
    assert 0 <= p1[0] <= p1[1] <= 1


def test_importances(rows):
    model = learners.gbt_fit(rows, max_iter=5, max_depth=3)
    ranked = feature_importance(model, ["a", "b", "c"]).orderBy("rank").collect()
    values = [r["importance"] for r in ranked]
    assert sum(values) == pytest.approx(1.0) and values == sorted(values, reverse=True)
    assert ranked[0]["feature"] == "a"
    with pytest.raises(ValueError):
        feature_importance(model, ["a"])


def test_cross_validation_scores_each_row_once(rows):
    folded = folds.fold_assign(rows, 4, "row_id")
    estimator = learners.estimator_predictor(learners.logreg(max_iter=20))
    scored = folds.cross_validate(folded, estimator, 4, ["row_id"], parallelism=4)
    assert scored.count() == rows.count() == scored.select("row_id").distinct().count()
    own = folded.select("row_id", "fold").exceptAll(scored.select("row_id", "fold"))
    assert own.count() == 0
    with pytest.raises(ValueError):
        folds.cross_validate(folded, estimator, 4, fit_scope="none")


def test_one_call_forms(rows):
    train, test = rows.filter("row_id % 4 > 0"), rows.filter("row_id % 4 = 0")
    for predicted in (
        bagging_predict(train, test, label="label", num_models=3, max_depth=2),
        adaboost_predict(train, test, label="label", rounds=2),
    ):
        assert predicted.columns == ["row_id", "label", "prediction", "probability"]
        assert predicted.count() == test.count()
    with pytest.raises(ValueError):
        bagging_predict(train, test.drop("row_id"), label="label", num_models=2)
    scores = kfold_scores(rows, learners.logreg(label="label", max_iter=20), 3, ["row_id"], "label")
    assert set(scores) == {"auc", "accuracy", "weighted_precision", "weighted_recall", "weighted_f1"}
    assert len(scores["auc"]["scores"]) == 3 and scores["auc"]["mean"] > 0.7
    bagged = bagging_kfold_scores(rows, 3, None, "label", num_models=3)
    assert set(bagged) == {"auc", "accuracy", "weighted_f1"} and bagged["auc"]["mean"] > 0.7
