"""Counts, previews and schema as tables, and the few values that reach the driver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def row_count(stages: dict[str, DataFrame]) -> DataFrame:
    """``(stage, n)`` for unrelated frames. Frames that filter one table belong in ``stage_counts``."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("stage"), "n") for name, df in stages.items()]
    return reduce(DataFrame.unionByName, counts)


def stage_counts(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """``(stage, n)`` left after each of a chain of filters, all from one pass over ``df``.

    A row counts for a stage when it passes that stage's condition and all before it.
    """
    passed = F.lit(True)
    counts = []
    for name, condition in steps.items():
        passed = passed & condition
        counts.append(F.count_if(passed).alias(name))
    wide = df.agg(*counts)
    return wide.unpivot([], list(steps), "stage", "n")


class ObservedCounts:
    """Counts of rows taken by the write that happens anyway, so that no scan is made for them.

    Rows are counted where the write's last stage reads them, so a task that is tried again counts once.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[Observation, list[str]]] = []

    def steps(self, df: DataFrame, steps: dict[str, Column]) -> DataFrame:
        """``df``, of which the next write counts what is left after each of a chain of filters."""
        passed, counts = F.lit(True), []
        for name, condition in steps.items():
            passed = passed & condition
            counts.append(F.count_if(passed).alias(name))
        seen = Observation()
        self._seen.append((seen, list(steps)))
        return df.observe(seen, *counts)

    def rows(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, of which the next write counts the rows."""
        return self.steps(df, {name: F.lit(True)})

    def table(self, spark: SparkSession) -> DataFrame:
        """``(stage, n)`` in the order of the observations. Waits until each of them was written."""
        rows = [(name, int(seen.get[name])) for seen, names in self._seen for name in names]
        return spark.createDataFrame(rows, "stage string, n bigint")


def preview(df: DataFrame, n: int, key: str | list[str]) -> DataFrame:
    """The first ``n`` rows by ``key``."""
    keys = [key] if isinstance(key, str) else key
    return df.orderBy(*keys).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """``(column, type, nullable)`` for each column of ``df``."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, nullable boolean")


def collect_scalar(df: DataFrame):
    """The one value of a one-row, one-column aggregate."""
    rows = df.take(2)
    if len(rows) != 1 or len(rows[0]) != 1:
        raise ValueError("collect_scalar needs exactly one row with one column")
    return rows[0][0]


def to_local(df: DataFrame, max_rows: int | None = None):
    """An aggregated frame as pandas. With ``max_rows`` it raises instead of pulling more rows than that.

    The caller names the bound that the driver can hold; none is assumed.
    """
    if max_rows is None:
        return df.toPandas()
    pdf = df.limit(max_rows + 1).toPandas()
    if len(pdf) > max_rows:
        raise ValueError(f"more than {max_rows} rows: aggregate first, or write the table")
    return pdf
