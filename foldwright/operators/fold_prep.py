"""Preparation without leaks from one scan: summaries of each fold, merged into those of each training part.

What preparation learns (how often each category occurs, mean and spread of each number) is a sum over
rows, so that of the rows outside a fold is the merge of the other folds' sums. One aggregate over the
folded table gives the summaries of all folds; everything after it works on one row per category and
fold. A training part's fitted state is one row: the values of its slots and each slot's mean and
standard deviation. It is joined to the rows it prepares and never reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.staging import stage

_ROWS = "_rows"


def _all_present(numeric: Sequence[str]) -> Column:
    """Whether no numeric input is missing; other rows are left out, as the assembler does."""
    return reduce(lambda held, c: held & F.col(c).isNotNull(), numeric, F.lit(True))


def _indicators(values: Column, value: Column) -> Column:
    return F.transform(values, lambda v: F.when(v.eqNullSafe(value), 1.0).otherwise(0.0))


def _prefixed(prefix: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.concat(F.lit(prefix), v))


def fold_summaries(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], fold: str = "fold") -> DataFrame:
    """``(fold, name, value, n, whole, mean, spread)`` from one aggregate over ``df``.

    A category has a row for each value: ``n`` rows, ``whole`` of them without a missing number. A number
    has one row: mean and sum of squared deviations over the ``whole`` rows. ``_rows`` counts all rows.
    """

    def part(name: str, value: Column | None, x: Column | None) -> Column:
        value = F.lit(None).cast("string") if value is None else value.cast("string")
        x = F.lit(None).cast("double") if x is None else x.cast("double")
        return F.struct(F.lit(name).alias("name"), value.alias("value"), x.alias("x"))

    parts = [part(_ROWS, None, None)]
    parts += [part(c, F.col(c), None) for c in categorical]
    parts += [part(c, None, F.col(c)) for c in numeric]
    long = df.select(F.col(fold).alias("fold"), _all_present(numeric).alias("present"), F.inline(F.array(*parts)))
    x = F.when(F.col("present"), F.col("x"))
    return long.groupBy("fold", "name", "value").agg(
        F.count("*").alias("n"),
        F.count_if("present").alias("whole"),
        F.avg(x).alias("mean"),
        (F.var_pop(x) * F.count(x)).alias("spread"),
    )


def training_summaries(summaries: DataFrame, k: int) -> DataFrame:
    """The summaries merged into those of each training part: ``part`` stands for all folds but that one."""
    parts = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("part")
    others = summaries.select("*", parts).filter(F.col("fold") != F.col("part"))
    merged = others.groupBy("part", "name", "value").agg(
        F.sum("n").alias("n"),
        F.sum("whole").alias("whole"),
        # At most k entries, one for each fold.
        F.collect_list(F.when(F.col("mean").isNotNull(), F.struct("whole", "mean", "spread"))).alias("moments"),
    )
    total = F.aggregate("moments", F.lit(0.0), lambda held, m: held + m["whole"] * m["mean"])
    mean = F.when(F.size("moments") > 0, F.try_divide(total, F.col("whole")))
    spread = F.aggregate(
        "moments",
        F.lit(0.0),
        lambda held, m: held + m["spread"] + m["whole"] * (m["mean"] - F.col("mean")) * (m["mean"] - F.col("mean")),
    )
    return merged.withColumn("mean", mean).withColumn("spread", F.when(F.col("mean").isNotNull(), spread)).drop("moments")


@dataclass(frozen=True)
class FoldPrep:
    """The fitted preparation of every training part.

    ``parts`` has one row for each: ``part, mean, std`` (an array over the slots) and ``values_<c>``, the
    values of a category in the order of its slots.
    """

    parts: DataFrame
    k: int
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]

    def transform(self, df: DataFrame, part: int | None = None, out: str = "features") -> DataFrame:
        """Add the standardized vector ``out`` by the state of ``part``; without one, each row by the state that did not see its ``fold``.

        Rows with a missing number are left out. Null and unseen categories have no slot.
        """
        names = {c: f"_{c}" for c in self.parts.columns}
        state = self.parts.withColumnsRenamed(names).withColumn("_of", F.col("_part"))
        if part is not None:
            # The one state for the rows of every fold.
            state = state.filter(F.col("_part") == part).withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(self.k - 1))))
        joined = df.filter(_all_present(self.numeric)).join(state, F.col("fold") == F.col("_of"))
        slots = [F.array(*[F.col(c).cast("double") for c in self.numeric])]
        for c in self.categorical:
            slots.append(_indicators(F.col(f"_values_{c}"), F.col(c).cast("string")))
        centered = F.zip_with(F.concat(*slots), F.col("_mean"), lambda x, m: x - m)
        scaled = F.zip_with(centered, F.col("_std"), lambda x, s: F.when(s > 0, x / s).otherwise(0.0))
        return joined.withColumn(out, array_to_vector(scaled)).drop("_of", *names.values())

    def slots(self) -> DataFrame:
        """``(part, slot, name, mean, std)``, one row for each slot."""
        names = F.array(*[F.lit(c) for c in self.numeric]) if self.numeric else F.array().cast("array<string>")
        for c in self.categorical:
            names = F.concat(names, _prefixed(f"{c}_VEC_", F.col(f"values_{c}")))
        slots = F.posexplode(F.arrays_zip(names.alias("name"), F.col("mean"), F.col("std")))
        return self.parts.select("part", slots).select("part", F.col("pos").alias("slot"), "col.name", "col.mean", "col.std")


def fold_prep(df: DataFrame, k: int, numeric: Sequence[str], categorical: Sequence[str], fold: str = "fold") -> FoldPrep:
    """Fit the preparation of each of ``k`` training parts from one scan of ``df``.

    Slots are the numbers, then each category's values by falling frequency in the part, ties by value.
    Standard deviations are sample ones; a constant slot has 0. A part of one fold that has no rows beside
    it has no slots for categories. Each value of a category becomes a slot of a vector, so a part's state
    is as wide as its vectors.
    """
    if k < 2:
        raise ValueError("k must be at least 2")
    merged = training_summaries(fold_summaries(df, numeric, categorical, fold), k)
    by_part = merged.groupBy("part", "name").agg(
        F.array_sort(
            F.collect_list(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("less"), "value", "whole")))
        ).alias("held"),
        F.max(F.when(F.col("value").isNull(), F.struct("whole", "mean", "spread"))).alias("number"),
    )
    named = [F.max(F.when(F.col("name") == _ROWS, F.col("number.whole"))).alias("whole")]
    named += [F.max(F.when(F.col("name") == c, F.col("number"))).alias(f"number_{c}") for c in numeric]
    empty = F.array().cast("array<struct<less: bigint, value: string, whole: bigint>>")
    named += [F.coalesce(F.max(F.when(F.col("name") == c, F.col("held"))), empty).alias(f"held_{c}") for c in categorical]
    wide = by_part.groupBy("part").agg(*named)

    whole = F.col("whole").cast("double")

    def std(spread: Column) -> Column:
        return F.when(whole > 1, F.sqrt(spread / (whole - 1))).otherwise(0.0)

    means = [F.array(*[F.coalesce(F.col(f"number_{c}.mean"), F.lit(0.0)) for c in numeric])]
    stds = [F.array(*[F.coalesce(std(F.col(f"number_{c}.spread")), F.lit(0.0)) for c in numeric])]
    for c in categorical:
        held = F.col(f"held_{c}")
        means.append(F.transform(held, lambda v: F.coalesce(F.try_divide(v["whole"], whole), F.lit(0.0))))
        stds.append(F.transform(held, lambda v: F.coalesce(std(v["whole"] * F.try_divide(whole - v["whole"], whole)), F.lit(0.0))))
    state = wide.select(
        "part",
        F.concat(*means).alias("mean"),
        F.concat(*stds).alias("std"),
        *[F.transform(F.col(f"held_{c}"), lambda v: v["value"]).alias(f"values_{c}") for c in categorical],
    )
    return FoldPrep(stage(state, "fold-prep"), k, tuple(numeric), tuple(categorical))
