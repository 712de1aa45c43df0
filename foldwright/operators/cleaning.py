"""Null rules, casts, filters, labels and buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType, StringType

_TESTS = {
    "==": lambda c, b: c == b,
    "<": lambda c, b: c < b,
    "<=": lambda c, b: c <= b,
}


def has_values(df: DataFrame, cols: Sequence[str]) -> Column:
    """True where none of the columns is null or, for floating numbers, NaN."""
    complete = F.lit(True)
    for name in cols:
        c = F.col(name)
        complete = complete & c.isNotNull()
        if isinstance(df.schema[name].dataType, FractionalType) and not isinstance(df.schema[name].dataType, DecimalType):
            complete = complete & ~F.isnan(c)
    return complete


def drop_null_subset(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the rows that lack a value in any of the columns.

    One condition per column, unlike ``dropna``: each reaches the scan or the join
    side that its column comes from, and turns an outer join into an inner one.
    """
    return df.filter(has_values(df, cols))


def as_date(df: DataFrame, name: str, strict: bool = False) -> Column:
    """A timestamp or string column of ``df`` as a date; a string that is none becomes null, or raises when ``strict``."""
    text = isinstance(df.schema[name].dataType, StringType)
    return (F.try_to_date if text and not strict else F.to_date)(F.col(name))


def cast_to_date(df: DataFrame, cols: Sequence[str], strict: bool = False) -> DataFrame:
    """Timestamps or strings to dates. A string that is no date becomes null, or raises when ``strict``."""
    return df.withColumns({name: as_date(df, name, strict) for name in cols})


def cast_int(df: DataFrame, name: str, strict: bool = False) -> DataFrame:
    """Numbers to int, cut toward zero. What does not fit becomes null, or raises when ``strict``."""
    c = F.col(name)
    return df.withColumn(name, c.cast("int") if strict else c.try_cast("int"))


def cast_double_label(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.col(name).cast("double"))


def drop_column(df: DataFrame, name: str) -> DataFrame:
    return df.drop(name)


def project(df: DataFrame, columns: dict[str, Column | str]) -> DataFrame:
    """Select ``{output name: expression or input column}``."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def add_column(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add all columns in one projection."""
    return df.withColumns(columns)


def filter_range(df: DataFrame, name: str, lo, hi) -> DataFrame:
    """Rows with ``lo <= name <= hi``; a null is outside."""
    return df.filter(F.col(name).between(lo, hi))


def filter_eq(df: DataFrame, name: str, value) -> DataFrame:
    return df.filter(F.col(name) == value)


def filter_ne(df: DataFrame, name: str, value) -> DataFrame:
    """Rows whose value differs; a null is dropped, as in SQL."""
    return df.filter(F.col(name) != value)


def binary_label(df: DataFrame, name: str, value, out: str) -> DataFrame:
    """1 where ``name`` equals ``value``, 0 elsewhere and for null."""
    return df.withColumn(out, F.when(F.col(name) == value, 1).otherwise(0))


def bucketize_case(
    df: DataFrame, name: str, buckets: Sequence[tuple[str, object, str]], default: str, out: str
) -> DataFrame:
    """The name of the first ``(operator, bound, name)`` that holds, else ``default`` (also for null)."""
    c = F.col(name)
    chain = None
    for operator, bound, label in buckets:
        if operator not in _TESTS:
            raise ValueError(f"unknown operator {operator!r}")
        test = _TESTS[operator](c, bound)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    if chain is None:
        raise ValueError("at least one bucket is needed")
    return df.withColumn(out, chain.otherwise(default))
