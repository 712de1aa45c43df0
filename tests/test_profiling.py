import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foldwright.operators import profiling as prof
from foldwright.operators.ordered import running_totals
from foldwright.operators.quantiles import boxplot_outliers, boxplot_stats


def test_correlation_of_constant_and_sparse_columns(spark):
    pdf = pd.DataFrame(
        {
            "x": [1.0, 2, 3, 4, 5, None],
            "y": [2.0, None, 5, 9, 8, 100],
            "c": [7.0] * 6,
            "only": [None, None, 1.0, None, None, None],
        }
    )
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "x double, y double, c double, only double")
    got = {(r["a"], r["b"]): r["r"] for r in prof.corr_matrix(df, list(pdf.columns)).collect()}
    want = pdf.corr()
    assert len(got) == 16
    for (a, b), r in got.items():
        if r is None:
            assert np.isnan(want.loc[a, b])
        else:
            assert r == pytest.approx(want.loc[a, b])


def test_describe_counts_values_only(spark):
    df = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    row = prof.describe_numeric(df, ["x"]).first()
    assert (row["n"], row["mean"], row["min"], row["max"]) == (2, 2.0, 1.0, 3.0)
    assert row["std"] == pytest.approx(np.std([1, 3], ddof=1))


def test_counts_include_nulls_and_break_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",), ("b",), ("c",)], "v string")
    assert [(r["value"], r["n"]) for r in prof.value_counts(df, "v").collect()] == [("a", 2), ("b", 2), (None, 1), ("c", 1)]


def test_mode_per_group_with_a_hot_group(spark):
    hot = spark.range(5000).select(F.lit("hot").alias("g"), (F.col("id") % 700).cast("string").alias("v"))
    cold = spark.createDataFrame([("cold", "x")], "g string, v string")
    got = prof.group_mode_top_n(hot.unionByName(cold), ["g"], "v", 2).orderBy("g", "rank").collect()
    assert [(r["g"], r["value"], r["count"], r["rank"]) for r in got] == [
        ("cold", "x", 1, 1),
        ("hot", "0", 8, 1),
        ("hot", "1", 8, 2),
    ]


def test_top_n_with_and_without_others(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 3.0), ("c", 3.0), (None, 1.0)], "n string, v double")
    got = [(r["n"], r["v"]) for r in prof.top_n_with_others(df, "n", "v", 2).orderBy("position").collect()]
    assert got == [("a", 5.0), ("b", 3.0), ("Others", 4.0)]
    got = [r["n"] for r in prof.top_n_with_others(df, "n", "v", 4).orderBy("position").collect()]
    assert got == ["a", "b", "c", None]


def test_shares(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 1.0)], "k string, v double")
    assert {r["k"]: r["pct"] for r in prof.share_of_total(df, "k", "v").collect()} == {"a": 75.0, "b": 25.0}
    assert {r["k"]: r["amount"] for r in prof.share_of_total(df, "k").collect()} == {"a": 2, "b": 1}


def test_running_totals_over_many_ranges(spark, many_ranges):
    rng = np.random.default_rng(1)
    values = rng.permutation(4000)
    pdf = pd.DataFrame({"g": np.where(values % 3 == 0, "a", np.where(values % 3 == 1, "b", None)), "v": values})
    pdf["m"] = rng.integers(1, 9, len(pdf))
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "g string, v long, m long")
    for descending in (False, True):
        got = running_totals(df.repartition(8), ["g"], "v", ["m"], descending).toPandas()
        assert len(got) == len(pdf)
        for _, part in got.groupby("g", dropna=False):
            part = part.sort_values("v", ascending=not descending)
            total = part["m"].cumsum()
            assert (part["m_before"] == total - part["m"]).all()
            assert (part["m_total"] == total.iloc[-1]).all()


def test_boxplot_against_numpy(spark, many_ranges):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": np.where(rng.random(3000) < 0.5, "wide", "hot")})
    pdf["x"] = np.where(pdf["g"] == "hot", np.round(rng.normal(size=3000), 1), rng.standard_cauchy(3000))
    pdf.loc[len(pdf)] = ["one", 4.0]
    got = boxplot_stats(spark.createDataFrame(pdf), ["g"], "x").toPandas().set_index("g")
    outliers = boxplot_outliers(spark.createDataFrame(pdf), ["g"], "x").toPandas()
    for g, part in pdf.groupby("g"):
        q1, median, q3 = np.percentile(part["x"], [25, 50, 75])
        reach = 1.5 * (q3 - q1)
        inside = part["x"][(part["x"] >= q1 - reach) & (part["x"] <= q3 + reach)]
        row = got.loc[g]
        assert row["n"] == len(part) and row["n_outliers"] == len(part) - len(inside)
        assert [row["q1"], row["median"], row["q3"]] == pytest.approx([q1, median, q3])
        assert [row["whisker_low"], row["whisker_high"]] == pytest.approx([inside.min(), inside.max()])
        assert outliers.loc[outliers["g"] == g, "n"].sum() == row["n_outliers"]
