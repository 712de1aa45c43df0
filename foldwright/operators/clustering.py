"""K-Means, its quality, the choice of K, and profiles of the clusters."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from foldwright.operators.kmeans_sweep import kmeans_sweep
from foldwright.staging import stage


def as_vector(df: DataFrame, features: str = "features") -> DataFrame:
    """Turn an array column into the vector column that MLlib reads; a vector stays as it is."""
    if isinstance(df.schema[features].dataType, ArrayType):
        return df.withColumn(features, array_to_vector(F.col(features).cast("array<double>")))
    return df


def kmeans_fit(df: DataFrame, k: int, max_iter: int = 50, seed: int = 42, features: str = "features") -> KMeansModel:
    return KMeans(featuresCol=features, predictionCol="cluster", k=k, seed=seed, maxIter=max_iter).fit(as_vector(df, features))


def nearest_center(df: DataFrame, centers: Sequence[Sequence[float]], features: str, out: str = "cluster") -> DataFrame:
    """Add the index of the nearest given center by squared distance, the lowest index on a tie.

    ``features`` is an array column. A null point, or one with a null or of another length
    than the centers, has no nearest center. The centers are a literal of the plan; a table
    of many is better kept in a fitted K-Means model.
    """
    table = F.from_json(F.lit(json.dumps([[float(x) for x in c] for c in centers])), "array<array<double>>")
    point = F.col(features).cast("array<double>")

    def distance(center: Column) -> Column:
        squares = F.zip_with(point, center, lambda x, y: (x - y) * (x - y))
        return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)

    far = F.transform(table, distance)
    return df.withColumn(out, (F.array_position(far, F.array_min(far)) - 1).cast("int"))


def silhouette(df: DataFrame, cluster: str = "cluster", features: str = "features") -> float:
    """Mean squared-Euclidean silhouette, from per-cluster sums in time linear in the rows."""
    evaluator = ClusteringEvaluator(
        featuresCol=features, predictionCol=cluster, metricName="silhouette", distanceMeasure="squaredEuclidean"
    )
    return evaluator.evaluate(as_vector(df, features))


def mark_best_k(scores: DataFrame) -> DataFrame:
    """Add ``chosen`` to ``(k, silhouette)``: true for the highest score, the smallest k on a tie."""
    best = scores.agg(F.max_by("k", F.struct(F.col("silhouette"), -F.col("k"))).alias("k")).scalar()
    return scores.withColumn("chosen", F.col("k") == best)


def choose_k(
    df: DataFrame,
    ks: Iterable[int] = range(2, 11),
    seed: int = 42,
    max_iter: int = 50,
    features: str = "features",
) -> DataFrame:
    """``(k, silhouette, chosen)`` by k: all k are fitted and scored together, in shared passes.

    The score is null where the rows have fewer than two distinct points.
    """
    scores, _ = kmeans_sweep(df, ks, seed, max_iter, features)
    return mark_best_k(stage(scores, "silhouettes")).orderBy("k")


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``(cluster, n)`` by cluster."""
    return df.groupBy(cluster).agg(F.count("*").alias("n")).orderBy(cluster)


def cluster_profile(df: DataFrame, numeric: Sequence[str], label: str, cluster: str = "cluster") -> DataFrame:
    """``(cluster, n, avg_<c>..., rate)`` for all clusters from one aggregate; ``rate`` is the label's percentage."""
    means = [F.avg(c).alias(f"avg_{c}") for c in numeric]
    rate = F.count_if(F.col(label) == 1) / F.count("*") * 100.0
    return df.groupBy(cluster).agg(F.count("*").alias("n"), *means, rate.alias("rate")).orderBy(cluster)
