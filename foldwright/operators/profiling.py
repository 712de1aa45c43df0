"""Counts, moments, correlations, modes and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwright.staging import stage


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """``(value, n)``, most frequent first, ties by value."""
    return df.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def value_counts_many(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` for several columns from one pass; values as strings."""
    names = list(names)
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in names])
    counts = texts.unpivot([], names, "column", "value").groupBy("column", "value").agg(F.count("*").alias("n"))
    return counts.orderBy("column", F.desc("n"), "value")


def describe_numeric(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(column, n, mean, std, min, max)`` with the sample standard deviation, all from one aggregate."""
    summaries = []
    for name in names:
        c = F.col(name).cast("double")
        summary = F.struct(
            F.lit(name).alias("column"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
        )
        summaries.append(summary)
    return df.agg(F.array(*summaries).alias("rows")).select(F.inline("rows"))


def _pearson(a: Column, b: Column) -> Column:
    """Pearson r over rows where both are present; null when either is constant there.

    The deviations are masked to the pairs that count, and the division is the
    guarded one, because ``corr`` raises on a constant column in ANSI mode.
    """
    both = a.isNotNull() & b.isNotNull()
    spread = F.stddev_samp(F.when(both, a)) * F.stddev_samp(F.when(both, b))
    return F.try_divide(F.covar_samp(a, b), spread)


def corr_matrix(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(a, b, r)`` for every ordered pair, all pairs from one aggregate."""
    cells = []
    for i, left in enumerate(names):
        for right in names[i:]:
            r = _pearson(F.col(left).cast("double"), F.col(right).cast("double"))
            cells.append(F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"), r.alias("r")))
    half = df.agg(F.array(*cells).alias("rows")).select(F.inline("rows"))
    mirrored = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b", "r"))).otherwise(
        F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    )
    return half.select(F.inline(mirrored))


def sum_agg(df: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Sums of expressions per group; no keys gives the overall sums."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(name) for name, c in measures.items()])


def avg_agg(df: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Means of expressions per group; no keys gives the overall means."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(name) for name, c in measures.items()])


def group_rate(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """``(keys, n, rate)``: the percentage of each group's rows whose 0/1 label is 1.

    Every row of the group is in the denominator, also one without a label.
    """
    hits = F.count_if(F.col(label) == 1)
    return df.groupBy(*keys).agg(F.count("*").alias("n"), (hits / F.count("*") * 100.0).alias("rate"))


def group_mode_top_n(df: DataFrame, keys: Sequence[str], name: str, n: int = 5) -> DataFrame:
    """``(keys, value, count, rank)`` of the ``n`` most frequent values in each group, ties by value.

    The rank filter is also applied before the shuffle, so a group with very many
    values sends only ``n`` candidates per task.
    """
    counts = df.groupBy(*keys, F.col(name).alias("value")).agg(F.count("*").alias("count"))
    order = Window.partitionBy(*keys).orderBy(F.desc("count"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def share_of_total(df: DataFrame, key: str, value: str | None = None) -> DataFrame:
    """``(key, amount, pct)``: each key's sum of ``value`` (or row count) as a percentage of the whole.

    The total comes from a scalar subquery over the per-key sums, not from a
    window over all of them.
    """
    amount = F.count("*") if value is None else F.sum(value)
    per_key = df.groupBy(key).agg(amount.alias("amount"))
    total = per_key.agg(F.sum("amount")).scalar()
    return per_key.select(key, "amount", F.try_divide(F.col("amount") * 100.0, total).alias("pct"))


def top_n_with_others(df: DataFrame, name: str, value: str, n: int = 5) -> DataFrame:
    """``(name, value, position)``: the ``n`` names with the largest sums, then the rest as ``Others``.

    There is no ``Others`` row when at most ``n`` names exist. Only the top ``n``
    rows are broadcast, and only they are gathered to be numbered.
    """
    # Staged, as both parts read them: one row per name.
    sums = stage(df.groupBy(F.col(name).cast("string").alias(name)).agg(F.sum(value).alias(value)), "sums")
    top = sums.orderBy(F.desc(value), name).limit(n)
    in_order = F.array_sort(F.collect_list(F.struct((-F.col(value)).alias("_low"), name, value)))
    numbered = top.agg(in_order.alias("_top")).select(F.posexplode("_top").alias("_place", "_row"))
    ranked = numbered.select(f"_row.{name}", f"_row.{value}", (F.col("_place") + 1).alias("position"))
    taken = F.broadcast(top.select(F.col(name).alias("_taken")))
    rest = sums.join(taken, F.col(name).eqNullSafe(F.col("_taken")), "left_anti")
    others = (
        rest.agg(F.sum(value).alias(value), F.count("*").alias("_names"))
        .filter(F.col("_names") > 0)
        .select(F.lit("Others").alias(name), value, F.lit(n + 1).alias("position"))
    )
    return ranked.unionByName(others)
