"""K-Means for several numbers of clusters at once.

A Lloyd step needs, for each cluster, the number and the sum of its points. One pass over the rows gives
these sums for the clusters of every k together, so a sweep costs as many passes as its slowest k and
not one chain of passes for each k. The same sums, with the squared lengths added up, give the mean
squared-Euclidean silhouettes of all k in one more pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from foldwright.staging import stage

#: A center that moves no further is settled.
TOLERANCE = 1e-4
#: Start centers are drawn from about this many rows, chosen by a hash of the point.
START_ROWS = 2048


def points_of(df: DataFrame, features: str = "features") -> DataFrame:
    """``(x)``: the points as arrays, written once. Null points take no part."""
    held = F.col(features)
    x = held.cast("array<double>") if isinstance(df.schema[features].dataType, ArrayType) else vector_to_array(held)
    return stage(df.filter(held.isNotNull()).select(x.alias("x")), "points")


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centers], axis=1)


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def _cluster_sums(centers: dict[int, np.ndarray]) -> Callable:
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros((len(c), c.shape[1] + 2)) for k, c in centers.items()}
        for batch in batches:
            if not len(batch):
                continue
            x = _rows(batch)
            full = np.hstack([np.ones((len(x), 1)), (x**2).sum(axis=1)[:, None], x])
            for k, c in centers.items():
                nearest = _distances(x, c).argmin(axis=1)
                member = (nearest[:, None] == np.arange(len(c))).astype(np.float64)
                total[k] += member.T @ full
        for k, sums in total.items():
            n = sums.size
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, k, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(sums.ravel())],
                names=["k", "cell", "value"],
            )

    return add_up


def cluster_sums(points: DataFrame, centers: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """For each k and cluster: points, sum of squared lengths, sum of points. A point belongs to its nearest center, the lowest on a tie.

    One pass; a few numbers for each center reach the driver.
    """
    found = points.mapInArrow(_cluster_sums(centers), "k int, cell int, value double")
    sums = {k: np.zeros(len(c) * (c.shape[1] + 2)) for k, c in centers.items()}
    for row in found.groupBy("k", "cell").agg(F.sum("value").alias("value")).toLocalIterator():
        sums[row["k"]][row["cell"]] = row["value"]
    return {k: s.reshape(len(centers[k]), -1) for k, s in sums.items()}


def lloyd(points: DataFrame, starts: dict[int, Sequence[Sequence[float]]], max_iter: int = 50) -> dict[int, np.ndarray]:
    """The centers of every k after at most ``max_iter`` steps from ``starts``; a center without points stays."""
    centers = {k: np.array(c, dtype=np.float64) for k, c in starts.items()}
    moving = set(centers)
    for _ in range(max_iter):
        if not moving:
            break
        for k, sums in cluster_sums(points, {k: centers[k] for k in moving}).items():
            held = sums[:, 0] > 0
            new = centers[k].copy()
            new[held] = sums[held, 2:] / sums[held, :1]
            if ((new - centers[k]) ** 2).sum(axis=1).max() <= TOLERANCE**2:
                moving.discard(k)
            centers[k] = new
    return centers


def _silhouette_sums(centers: dict[int, np.ndarray], sums: dict[int, np.ndarray]) -> Callable:
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = dict.fromkeys(centers, 0.0), 0
        for batch in batches:
            if not len(batch):
                continue
            x = _rows(batch)
            n += len(x)
            square = (x**2).sum(axis=1)[:, None]
            for k, c in centers.items():
                size = sums[k][:, 0]
                held = np.flatnonzero(size)
                own = np.searchsorted(held, _distances(x, c).argmin(axis=1))
                size = size[held]
                mean = square + sums[k][held, 1] / size - 2.0 * (x @ (sums[k][held, 2:] / size[:, None]).T)
                at = np.arange(len(x))
                inner = np.maximum(mean[at, own], 0.0) * size[own] / np.maximum(size[own] - 1.0, 1.0)
                mean[at, own] = np.inf
                outer = mean.min(axis=1)
                most = np.maximum(inner, outer)
                value = np.divide(outer - inner, most, out=np.zeros_like(most), where=(most > 0) & (size[own] > 1))
                total[k] += float(value.sum())
        for k, value in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([value]), pa.array([n], pa.int64())], names=["k", "value", "n"])

    return add_up


def silhouettes(points: DataFrame, centers: dict[int, np.ndarray]) -> DataFrame:
    """``(k, silhouette)`` of every k's nearest-center clusters, in two passes; null where fewer than two clusters have points."""
    sums = cluster_sums(points, centers)
    scored = {k: c for k, c in centers.items() if (sums[k][:, 0] > 0).sum() > 1}
    none = [(int(k), None) for k in centers if k not in scored]
    rows = points.sparkSession.createDataFrame(none, "k int, silhouette double")
    if not scored:
        return rows
    found = points.mapInArrow(_silhouette_sums(scored, sums), "k int, value double, n bigint")
    return found.groupBy("k").agg((F.sum("value") / F.sum("n")).alias("silhouette")).unionByName(rows)


def start_centers(points: DataFrame, ks: Iterable[int], seed: int = 42, rows: int = START_ROWS) -> dict[int, np.ndarray]:
    """Start centers for every k: spread draws, by squared distance, from a bounded sample of distinct points.

    The sample is chosen by a hash of the point, so it is the same under any partitioning. The centers of
    a smaller k are the first ones of a larger k. With fewer distinct points than k there are fewer centers.
    """
    n = points.count()
    drawn = points if n <= rows else points.filter(F.pmod(F.xxhash64("x", F.lit(seed)), F.lit(1 << 30)) < int((1 << 30) * rows / n))
    # Equal points share a hash; a few heavy points may be all that is drawn, so the order is a hash as well.
    sample = drawn.distinct().orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(2 * rows)
    x = np.array([r["x"] for r in sample.collect()], dtype=np.float64)
    if not len(x):
        x = np.array([r["x"] for r in points.orderBy("x").limit(1).collect()], dtype=np.float64)
    if not len(x):
        raise ValueError("clusters need at least one point")
    chance = np.random.default_rng(seed)
    chosen = [x[0]]
    far = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < max(ks) and far.max() > 0:
        chosen.append(x[chance.choice(len(x), p=far / far.sum())])
        far = np.minimum(far, ((x - chosen[-1]) ** 2).sum(axis=1))
    return {int(k): np.array(chosen[:k]) for k in ks}


def kmeans_sweep(df: DataFrame, ks: Iterable[int], seed: int = 42, max_iter: int = 50, features: str = "features") -> tuple[DataFrame, dict[int, np.ndarray]]:
    """``(k, silhouette)`` and the centers for every k, all of them fitted in shared passes."""
    points = points_of(df, features)
    centers = lloyd(points, start_centers(points, sorted(set(ks)), seed), max_iter)
    return silhouettes(points, centers), centers
