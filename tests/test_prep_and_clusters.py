import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from foldwright.operators import clustering, prep


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, 10.0, "x", "p"), (2, 20.0, "x", "q"), (3, 30.0, "y", "q"), (4, 40.0, "z", "q"), (5, None, "y", "q")]
    return spark.createDataFrame(rows, "id int, n double, a string, b string")


def test_slots_and_their_names(people):
    ready = prep.fit_prep(people, ["n"], ["a", "b"]).transform(people)
    # x and y come before z, ties by name; the row with a null number is dropped
    assert prep.feature_names(ready) == ["n", "a_VEC_x", "a_VEC_y", "a_VEC_z", "b_VEC_q", "b_VEC_p"]
    assert ready.count() == 4
    with pytest.raises(ValueError):
        prep.feature_names(ready, "features")
    means = ready.select(vector_to_array("features").alias("f")).collect()
    values = np.array([r["f"] for r in means])
    assert np.allclose(values.mean(axis=0), 0) and np.allclose(values.std(axis=0, ddof=1), 1)


def test_unseen_and_null_categories_are_all_zero(spark, people):
    fitted = prep.fit_prep(people, ["n"], ["a"])
    new = spark.createDataFrame([(9, 1.0, "new", "p"), (10, 1.0, None, "p")], people.schema)
    got = [r["v"] for r in fitted.transform(new).select(vector_to_array("a_VEC").alias("v")).collect()]
    assert got == [[0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]


def test_constant_slot_becomes_zero(spark):
    df = prep.assemble(spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "x double, c double"), ["x", "c"], "v")
    scaled = prep.standardize(df, "v", "s").select(vector_to_array("s").alias("s")).collect()
    assert [r["s"][1] for r in scaled] == [0.0, 0.0]


def test_any_number_of_values_is_indexed(spark):
    """50,000 values, one of them in a third of all rows, and nulls."""
    df = spark.range(75_000).select(F.when(F.col("id") < 50_000, F.col("id").cast("string")).when(F.col("id") < 74_000, "7").alias("a"))
    got = prep.string_index(df, ["a"])
    assert got.filter("a = '7'").select("a_IDX").distinct().collect() == [(0.0,)]
    assert got.filter("a is null").select("a_IDX").distinct().collect() == [(50_000.0,)]
    assert got.filter("a is not null").agg(F.count_distinct("a_IDX"), F.max("a_IDX")).first() == (50_000, 49_999.0)


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(6)
    centers = np.array([[0.0, 0.0], [8.0, 0.0], [0.0, 8.0]])
    owner = rng.integers(0, 3, 300)
    x = centers[owner] + rng.normal(size=(300, 2))
    pdf = pd.DataFrame({"id": np.arange(300), "owner": owner, "x": x[:, 0], "y": x[:, 1]})
    return spark.createDataFrame(pdf).withColumn("point", F.array("x", "y")).cache()


def test_silhouette_by_brute_force(points):
    pdf = points.toPandas()
    xy, owner = pdf[["x", "y"]].to_numpy(), pdf["owner"].to_numpy()
    d = ((xy[:, None] - xy[None]) ** 2).sum(axis=2)
    scores = []
    for i, own in enumerate(owner):
        inside = d[i][owner == own].sum() / ((owner == own).sum() - 1)
        outside = min(d[i][owner == c].mean() for c in set(owner) - {own})
        scores.append((outside - inside) / max(inside, outside))
    assert clustering.silhouette(points, "owner", "point") == pytest.approx(np.mean(scores))


def test_k_is_chosen_by_silhouette(spark, points):
    vectors = points.select(array_to_vector("point").alias("features"))
    swept = clustering.choose_k(vectors, range(2, 6)).orderBy("k").collect()
    assert [r["k"] for r in swept if r["chosen"]] == [3]
    tied = spark.createDataFrame([(4, 0.5), (2, 0.5), (3, 0.1)], "k int, silhouette double")
    assert [r["k"] for r in clustering.mark_best_k(tied).collect() if r["chosen"]] == [2]


def test_equal_points_have_no_silhouette(spark):
    same = spark.range(20).select(array_to_vector(F.array(F.lit(1.0), F.lit(2.0))).alias("features"))
    assert [(r["k"], r["silhouette"]) for r in clustering.choose_k(same, [2, 3]).collect()] == [(2, None), (3, None)]


def test_clusters_of_the_chosen_k(points):
    vectors = points.withColumn("features", array_to_vector("point"))
    assigned = clustering.kmeans_fit(vectors, 3).transform(vectors)
    assert assigned.groupBy("owner").agg(F.count_distinct("cluster").alias("n")).filter("n > 1").count() == 0


def test_nearest_center_ties_and_nulls(spark):
    rows = [([0.0],), ([1.0],), ([5.0],), ([None],), (None,), ([1.0, 2.0],)]
    near = clustering.nearest_center(spark.createDataFrame(rows, "p array<double>").repartition(5), [[0.0], [2.0], [9.0]], "p")
    got = sorted(((r["p"], r["cluster"]) for r in near.collect()), key=repr)
    assert got == sorted([([0.0], 0), ([1.0], 0), ([5.0], 1), ([None], None), (None, None), ([1.0, 2.0], None)], key=repr)
    assert "Python" not in near._jdf.queryExecution().toString()


def test_cluster_queries_plan_no_python(spark, sf_dir):
    from foldwright.checks import queries as q

    for name in ("nearest_center", "cluster_sizes", "cluster_profile", "cluster_modes"):
        assert "Python" not in q.registered()[name](spark, sf_dir)._jdf.queryExecution().toString()


def test_profile_has_no_row_for_an_empty_cluster(spark):
    df = spark.createDataFrame([(0, 10.0, 1), (0, 20.0, 0), (2, 5.0, None)], "cluster int, age double, label int")
    got = [tuple(r) for r in clustering.cluster_profile(df, ["age"], "label").collect()]
    assert got == [(0, 2, 15.0, 50.0), (2, 1, 5.0, 0.0)]
    assert [tuple(r) for r in clustering.cluster_sizes(df).collect()] == [(0, 2), (2, 1)]
