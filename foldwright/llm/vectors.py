"""What both vector searches share: usable vectors, blocks, and the best of each query."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether the vector is there, has components, and all of them are finite numbers."""

    def sound(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)

    some = F.col(vector).isNotNull() & (F.size(vector) > 0)
    return F.coalesce(some & F.forall(vector, sound), F.lit(False))


def one_row_per_id(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v``: ids that occur again are one row with their smallest vector; null ids are left out."""
    named = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).alias("v")).filter("id is not null")
    return named.groupBy("id").agg(F.min("v").alias("v"))


def block_count(rows: int, most: int, least: int, parts: int) -> int:
    """Blocks of at most ``most`` rows; more, down to ``least`` rows each, while there are idle partitions."""
    return max(1, math.ceil(rows / most), min(parts, math.ceil(rows / least)))


def parallel_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def renewed(df: DataFrame) -> DataFrame:
    """The same columns under new identities, so that a table can be grouped with itself."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def stacked(column) -> np.ndarray:
    return np.stack(column.to_numpy())


def best(found: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest scores of each query, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
