"""Exact quartiles and box-plot limits for groups of any size, without sorting the groups.

A mergeable quantile sketch brackets each quartile: its error is bounded, so the rank lies between two of
its values. A second scan counts the rows below, between and above the brackets and keeps only the values
inside them; those few are ordered, and the counts say which of them has the rank. No row is moved but
counts and values inside a bracket.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwright.staging import stage

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
#: The sketch is wrong by one part of the rows in this many at most, and a bracket reaches twice as far.
ACCURACY = 2000
#: Of a group with no more rows than this, all values are kept.
SMALL_GROUP = 4 * ACCURACY


def _same_group(keys: Sequence[str]) -> Column:
    """Joins each row to its group's row of figures, a null group to its own."""
    return reduce(lambda held, k: held & F.col(k).eqNullSafe(F.col(f"_of_{k}")), keys, F.lit(True))


def _joined(df: DataFrame, figures: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``figures`` are staged, so the join knows their size: Spark broadcasts few of them, and splits a large group when it must shuffle."""
    named = figures.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    return df.join(named, _same_group(keys), "inner").drop(*[f"_of_{k}" for k in keys])


def _brackets(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, _n, _low, _high)``: the rows of each group and, in order, the ends of its brackets; null for a small group."""
    reach = 2.0 / ACCURACY
    lows = F.percentile_approx("_value", [max(0.0, p - reach) for p in QUARTILES.values()], ACCURACY)
    highs = F.percentile_approx("_value", [min(1.0, p + reach) for p in QUARTILES.values()], ACCURACY)
    found = values.groupBy(*keys).agg(F.count("*").alias("_n"), lows.alias("_low"), highs.alias("_high"))
    large = F.col("_n") > SMALL_GROUP
    return found.select(*keys, "_n", F.when(large, F.col("_low")).alias("_low"), F.when(large, F.col("_high")).alias("_high"))


def _counted(values: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, _n, _value, _rows, _before)``: the values inside brackets, with how many rows hold and precede each."""
    value = F.col("_value")
    ends = range(len(QUARTILES))
    inside = [value.between(F.get("_low", F.lit(i)), F.get("_high", F.lit(i))) for i in ends]
    kept = F.col("_low").isNull() | reduce(lambda a, b: a | b, inside)
    # Rises with the value, and differs between the inside of a bracket and what lies around it.
    region = reduce(
        lambda a, b: a + b,
        [(F.get("_low", F.lit(i)) <= value).cast("int") + (F.get("_high", F.lit(i)) < value).cast("int") for i in ends],
    )
    placed = _joined(values, brackets, keys).select(
        *keys, "_n", F.coalesce(region, F.lit(0)).alias("_region"), F.when(kept, value).alias("_value")
    )
    counted = placed.groupBy(*keys, "_region", "_value").agg(F.first("_n").alias("_n"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_region", "_value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    return ranked.filter(F.col("_value").isNotNull()).drop("_region")


def _value_at(rank: Column) -> Column:
    """Aggregate: the value that covers a 0-based rank."""
    covers = (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_rows"))
    return F.max(F.when(covers, F.col("_value")))


def quartiles(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(keys, n, q1, median, q3)`` over the rows with a value: linear interpolation around ``(n - 1) * p``."""
    keys = list(keys)
    values = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value"))
    brackets = stage(_brackets(values, keys), "brackets")
    aggregates = [F.first("_n").alias("n")]
    for name, p in QUARTILES.items():
        rank = (F.col("_n") - 1) * p
        aggregates.append(_value_at(F.floor(rank)).alias(f"{name}_lo"))
        aggregates.append(_value_at(F.ceil(rank)).alias(f"{name}_hi"))
    found = stage(_counted(values, brackets, keys).groupBy(*keys).agg(*aggregates), "quartiles")
    ends = [F.col(f"{name}_{side}") for name in QUARTILES for side in ("lo", "hi")]
    missed = found.filter(reduce(lambda a, b: a | b, [e.isNull() for e in ends]))
    if not missed.isEmpty():
        # Values that the sketch cannot tell apart (whole numbers beyond 2**53): such groups keep all their values.
        again = _joined(brackets, missed.select(*keys), keys).select(*keys, "_n", *[F.lit(None).cast(t).alias(c) for c, t in brackets.dtypes[-2:]])
        whole = _counted(values, stage(again, "brackets"), keys).groupBy(*keys).agg(*aggregates)
        found = found.filter(reduce(lambda a, b: a & b, [e.isNotNull() for e in ends])).unionByName(whole)
    columns = []
    for name, p in QUARTILES.items():
        rank = (F.col("n") - 1) * p
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        columns.append((lo + (hi - lo) * (rank - F.floor(rank))).alias(name))
    return found.select(*keys, "n", *columns)


def _with_quartiles(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(keys, _value, n, q1, median, q3)`` for each row with a value."""
    values = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value"))
    return _joined(values, stage(quartiles(df, keys, value), "quartiles"), keys)


def _inside(whis: float) -> Column:
    reach = (F.col("q3") - F.col("q1")) * F.lit(float(whis))
    return F.col("_value").between(F.col("q1") - reach, F.col("q3") + reach)


def boxplot_stats(df: DataFrame, keys: Sequence[str], value: str, whis: float = 1.5) -> DataFrame:
    """``(keys, n, q1, median, q3, whisker_low, whisker_high, n_outliers)`` per group.

    A whisker ends at the outermost value within ``whis`` interquartile ranges of
    the box, and at the box itself when no value lies there.
    """
    rows = _with_quartiles(df, list(keys), value)
    kept = F.when(_inside(whis), F.col("_value"))
    box = ["n", *QUARTILES]
    ends = rows.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in box],
        F.min(kept).alias("_low"),
        F.max(kept).alias("_high"),
        F.count_if(~_inside(whis)).alias("n_outliers"),
    )
    return ends.select(
        *keys,
        *box,
        F.least("_low", "q1").alias("whisker_low"),
        F.greatest("_high", "q3").alias("whisker_high"),
        "n_outliers",
    )


def boxplot_outliers(df: DataFrame, keys: Sequence[str], value: str, whis: float = 1.5) -> DataFrame:
    """``(keys, value, n)``: the values beyond the whiskers and how many rows hold each."""
    beyond = _with_quartiles(df, list(keys), value).filter(~_inside(whis))
    return beyond.groupBy(*keys, F.col("_value").alias(value)).agg(F.count("*").alias("n"))
