"""Reading tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StructType


def _read_as(name: str, kind: DataType) -> Column:
    """The text as ``kind``, null where it does not fit. ``3.0`` is an integer, ``3.5`` is none."""
    text = F.trim(F.col(name))
    if not isinstance(kind, IntegralType):
        return F.col(name).try_cast(kind)
    exact = text.try_cast("decimal(38,18)")
    return F.when(exact == F.floor(exact), exact.try_cast(kind))


def _texts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    texts = spark.read.option("header", True).csv(path)
    missing = [f.name for f in schema.fields if f.name not in texts.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return texts


def scan_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a CSV with a header.

    Columns of ``schema`` are found by name, in any order, and cast; a cell that does
    not fit becomes null, and ``scan_report`` counts those. A whole number may be
    written with a fraction of zeros, as exports of columns with gaps do. Other columns
    stay strings. Without a schema the types are inferred, which reads the data twice.
    """
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return _texts(spark, path, schema).withColumns({f.name: _read_as(f.name, f.dataType) for f in schema.fields})


def scan_report(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``(column, filled, unreadable)``: cells with a text, and those of them that do not fit the declared type."""
    texts = _texts(spark, path, schema)
    counts = []
    for f in schema.fields:
        filled = F.coalesce(F.trim(F.col(f.name)) != "", F.lit(False))
        lost = filled & _read_as(f.name, f.dataType).isNull()
        counts.append(F.struct(F.count_if(filled).alias("filled"), F.count_if(lost).alias("unreadable")).alias(f.name))
    wide = texts.agg(*counts)
    names = [f.name for f in schema.fields]
    rows = F.array(*[F.struct(F.lit(n).alias("column"), F.col(n)["filled"].alias("filled"), F.col(n)["unreadable"].alias("unreadable")) for n in names])
    return wide.select(F.inline(rows))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table ``name`` of a folder that holds one parquet table per name."""
    return scan_parquet(spark, f"{folder.rstrip('/')}/{name}.parquet")
