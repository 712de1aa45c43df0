"""Exact running totals over a sorted key, without putting a whole group into one task.

A window ordered by value sends all rows of a group to one task, and a fold or a
group may hold most of the table. Here the rows are first cut into ranges of the
sorted key, each range is summed on its own, and only the per-range sums (one row
per group and range) are ordered within a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwright.staging import stage

RANGE = "_range"


def sort_key(order: str, descending: bool) -> Column:
    return F.col(order).desc() if descending else F.col(order).asc()


def cut_into_ranges(df: DataFrame, keys: Sequence[str], order: str, descending: bool = False) -> DataFrame:
    """Range-partition by ``(keys, order)`` and number the ranges in sort order.

    The rows must be unique by ``(keys, order)``: then no value can fill a range.
    The numbers hold within one execution only, as range bounds come from a sample;
    read them once, or stage the result.
    """
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], sort_key(order, descending))
    return ranged.withColumn(RANGE, F.spark_partition_id())


def before_in_range(keys: Sequence[str], order: str, descending: bool = False):
    return (
        Window.partitionBy(*keys, RANGE)
        .orderBy(sort_key(order, descending))
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def earlier_ranges(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)


def running_totals(
    df: DataFrame, keys: Sequence[str], order: str, measures: Sequence[str], descending: bool = False
) -> DataFrame:
    """Add ``<m>_before`` (sum over the rows sorted before this one) and ``<m>_total`` per group.

    ``df`` must be unique by ``(keys, order)`` and ``order`` must not be null.
    The cut rows are staged, since two branches read the same range numbers.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("running_totals needs at least one key column")
    cut = stage(cut_into_ranges(df, keys, order, descending), "ranges")
    sums = cut.groupBy(*keys, RANGE).agg(*[F.sum(m).alias(f"{m}_sum") for m in measures])
    group = Window.partitionBy(*keys)
    offsets = sums.select(
        *[F.col(k).alias(f"_at_{k}") for k in keys],
        F.col(RANGE).alias("_at_range"),
        *[F.coalesce(F.sum(f"{m}_sum").over(earlier_ranges(keys)), F.lit(0)).alias(f"{m}_offset") for m in measures],
        *[F.sum(f"{m}_sum").over(group).alias(f"{m}_total") for m in measures],
    )
    inside = cut.withColumns(
        {f"{m}_inside": F.coalesce(F.sum(m).over(before_in_range(keys, order, descending)), F.lit(0)) for m in measures}
    )
    same = F.col(RANGE) == F.col("_at_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_at_{k}"))
    joined = inside.join(offsets, same, "inner")
    totals = joined.withColumns({f"{m}_before": F.col(f"{m}_inside") + F.col(f"{m}_offset") for m in measures})
    return totals.select(*df.columns, *[f"{m}_before" for m in measures], *[f"{m}_total" for m in measures])
