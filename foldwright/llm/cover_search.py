"""Exact top-k by inner product with cover trees over queries and data.

The top of the tree is a net of pivots, chosen farthest-first from a bounded sample; every row belongs
to its nearest pivot, and a pivot's cell has a covering radius. Below that, each block of a cell gets a
cover tree of its own in the task that searches it. Two nodes with centers a, b and covering radii
s, t hold no product above ``a.b + s|b| + t|a| + st``; a pair of nodes is left out if that is below the
worst kth score of its query group. The sample's own scores give every query a first kth score, so
whole pairs of cells are pruned before any vector is moved, and the trees prune inside a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappush, heappushpop

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.llm.vectors import best, block_count, finite, one_row_per_id, parallel_parts, renewed, stacked
from foldwright.staging import stage

SAMPLE_ROWS = 1024
MOST_PIVOTS = 128
BLOCK_ROWS = 2048
LEAST_ROWS = 256
LEAF_ROWS = 64
SHRINK = 0.8
#: A net with fewer rows per center than this prunes less than it costs; its node stays a leaf.
ROWS_PER_CENTER = 16


# -- trees ----------------------------------------------------------------------------------------


class CoverTree:
    """Nodes as ranges of a permutation: center, covering radius, children within ``SHRINK`` of the radius."""

    def __init__(self, points: np.ndarray) -> None:
        self.order = np.arange(len(points))
        self.centers: list[np.ndarray] = []
        self.radius: list[float] = []
        self.ranges: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        todo = [(0, len(points), -1)]
        while todo:
            start, end, parent = todo.pop()
            inside = self.order[start:end]
            node = len(self.radius)
            if parent >= 0:
                self.children[parent].append(node)
            center = points[inside[0]]
            away = np.linalg.norm(points[inside] - center, axis=1)
            self.centers.append(center)
            self.radius.append(float(away.max()))
            self.ranges.append((start, end))
            self.children.append([])
            if end - start <= LEAF_ROWS or self.radius[node] == 0:
                continue
            # Farthest-first: each new center is farther than the covering distance from all others.
            owner, n = np.zeros(len(inside), dtype=np.int64), 1
            most = (end - start) // ROWS_PER_CENTER
            while away.max() > SHRINK * self.radius[node] and n <= most:
                far = int(away.argmax())
                other = np.linalg.norm(points[inside] - points[inside[far]], axis=1)
                closer = other < away
                owner[closer], away[closer] = n, other[closer]
                n += 1
            if n > most:
                continue
            split = np.lexsort((away, owner))
            self.order[start:end] = inside[split]
            cuts = np.flatnonzero(np.diff(owner[split], prepend=-1, append=n))
            todo += [(start + a, start + b, node) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        self.center = np.array(self.centers)
        self.norm = np.linalg.norm(self.center, axis=1)
        self.reach = np.array(self.radius)


def product_bound(dot, norm_a, norm_b, reach_a, reach_b):
    """No product of two points within the radii is larger; a little is added for rounding."""
    bound = dot + reach_a * norm_b + reach_b * norm_a + reach_a * reach_b
    return bound + 1e-9 * (np.abs(bound) + norm_a * norm_b) + 1e-6


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products; in double precision where every sum is below 2**53."""
    if len(a) and len(b) and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def dual_search(query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple]:
    """``(query, id, score)``: up to k per query, among them all of its k best that reach its floor."""
    asked, stored = CoverTree(queries.astype(np.float64)), CoverTree(rows.astype(np.float64))
    q_ids, q_rows, worst = query_ids[asked.order], queries[asked.order], floors[asked.order].astype(np.float64)
    r_ids, r_rows = ids[stored.order], rows[stored.order]
    heaps: list[list[tuple[int, int]]] = [[] for _ in q_ids]

    def compare(q: tuple[int, int], r: tuple[int, int]) -> None:
        scores = _exact(q_rows[q[0] : q[1]], r_rows[r[0] : r[1]])
        good = (scores >= worst[q[0] : q[1], None]) & (q_ids[q[0] : q[1], None] != r_ids[r[0] : r[1]])
        # Of many equal scores only the k that can stay are looked at one by one.
        for row in np.flatnonzero(good.sum(axis=1) > 8 * k):
            hits = np.flatnonzero(good[row])
            good[row, hits[np.lexsort((r_ids[hits + r[0]], -scores[row, hits]))[k:]]] = False
        i, j = np.nonzero(good)
        names = r_ids[j + r[0]].tolist()
        for at, name, score in zip((i + q[0]).tolist(), names, scores[i, j].tolist(), strict=True):
            heap = heaps[at]
            if len(heap) < k:
                heappush(heap, (score, -name))
            elif (score, -name) > heap[0]:
                heappushpop(heap, (score, -name))
            if len(heap) == k:
                worst[at] = max(worst[at], heap[0][0])

    todo = [(0, 0, np.inf)]
    while todo:
        a, b, bound = todo.pop()
        q, r = asked.ranges[a], stored.ranges[b]
        if bound < worst[q[0] : q[1]].min():
            continue
        below_a, below_b = asked.children[a], stored.children[b]
        if not below_a and not below_b:
            compare(q, r)
            continue
        if below_a and (not below_b or asked.reach[a] >= stored.reach[b]):
            left, right = np.array(below_a), np.array([b])
        else:
            left, right = np.array([a]), np.array(below_b)
        dots = asked.center[left] @ stored.center[right].T
        bounds = product_bound(dots, asked.norm[left, None], stored.norm[right], asked.reach[left, None], stored.reach[right])
        # The pair with the best centers is looked at first.
        for at in np.argsort(dots, axis=None).tolist():
            i, j = divmod(at, len(right))
            todo.append((int(left[i]), int(right[j]), float(bounds[i, j])))
    return [(int(query), -name, score) for query, heap in zip(q_ids, heaps, strict=True) for score, name in heap]


# -- the search ---------------------------------------------------------------------------------


def _pivots(points: np.ndarray, most: int) -> np.ndarray:
    """Farthest-first net: no two chosen points are nearer than the covering distance it ends with."""
    chosen = [0]
    away = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < most and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return points[chosen]


def _placed(sample_ids: np.ndarray, sample: np.ndarray, pivots: np.ndarray, k: int):
    """Cell and distance of every row; for queries, the kth best score within the sample as a floor."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            points = stacked(batch["v"])
            away = np.stack([np.linalg.norm(points - p, axis=1) for p in pivots], axis=1)
            batch["cell"] = away.argmin(axis=1).astype(np.int32)
            batch["away"] = away.min(axis=1)
            floors = np.full(len(batch), -np.inf)
            asking = np.flatnonzero(batch["asks"].to_numpy())
            if len(asking) and len(sample) > k:
                scores = _exact(points[asking], sample).astype(np.float64)
                scores[batch["id"].to_numpy()[asking, None] == sample_ids] = -np.inf
                floors[asking] = np.partition(scores, -k, axis=1)[:, -k]
            batch["floor"] = floors
            yield batch

    return place


def _tile(k: int):
    def tile(asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asked) and len(stored):
            found = dual_search(
                asked["id"].to_numpy(), stacked(asked["v"]), asked["floor"].to_numpy(), stored["id"].to_numpy(), stacked(stored["v"]), k
            )
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    return tile


def top_products(
    vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest integer products of ``floor(scale * x)`` vectors.

    ``is_query`` is a condition on column ``id`` (the key as a long). A query's own row is no candidate;
    ties go to the smaller id; with fewer candidates all are returned. Vectors that are null, empty or
    hold null or non-finite components take no part, nor do rows without an id; an id that occurs again
    is one row with its smallest vector. Vectors of different lengths do not meet: each length is
    searched on its own. Scores must fit a long.
    """
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    usable = vectors.filter(finite(vector)).select(F.col(key), whole.alias("_whole"))
    rows = stage(one_row_per_id(usable, key, "_whole").withColumns({"dim": F.size("v"), "asks": is_query}), "whole-vectors")
    found = None
    for row in rows.groupBy("dim").count().collect():
        some = _search(rows.filter(F.col("dim") == row["dim"]).drop("dim"), row["count"], k)
        found = some if found is None else found.union(some)
    if found is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score"))
    return best(found, k)


def _search(rows: DataFrame, count: int, k: int) -> DataFrame:
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("id", "v").collect()
    sample_ids, sample = np.array([r["id"] for r in drawn]), np.array([r["v"] for r in drawn], dtype=np.int64)
    parts = parallel_parts(rows)
    pivots = _pivots(sample.astype(np.float64), min(MOST_PIVOTS, block_count(count, BLOCK_ROWS, LEAST_ROWS, parts)))
    schema = "id bigint, v array<bigint>, asks boolean, cell int, away double, floor double"
    placed = stage(rows.mapInPandas(_placed(sample_ids, sample, pivots, k), schema), "cells")

    # One row per cell: at most MOST_PIVOTS, so the pairs of cells are decided here.
    sides = [
        {r["cell"]: r for r in side.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("reach"), F.min("floor").alias("worst")).collect()}
        for side in (placed.filter("asks"), placed)
    ]
    norms = np.linalg.norm(pivots, axis=1)
    group, filled, groups = {}, 0, 0
    for cell in sorted(sides[0]):  # neighbouring query cells share a group of up to BLOCK_ROWS queries
        filled += sides[0][cell]["n"]
        group[cell] = groups
        if filled >= BLOCK_ROWS:
            filled, groups = 0, groups + 1
    wanted: dict[int, set[int]] = {}
    for a, asked in sides[0].items():
        for b, stored in sides[1].items():
            bound = product_bound(float(pivots[a] @ pivots[b]), norms[a], norms[b], asked["reach"], stored["reach"])
            if bound >= asked["worst"]:
                wanted.setdefault(group[a], set()).add(b)
    spark = rows.sparkSession
    plan = [
        (cell, g, b, part, -(-sides[1][b]["n"] // BLOCK_ROWS), -(-sides[0][cell]["n"] // BLOCK_ROWS))
        for cell, g in group.items()
        for b in sorted(wanted.get(g, ()))
        for part in range(-(-sides[1][b]["n"] // BLOCK_ROWS))
    ]
    shape = "asking int, grp int, cell int, part int, parts int, slices int"
    pairs = spark.createDataFrame(plan, shape)
    queries = placed.filter("asks").select("id", "v", "floor", F.col("cell").alias("asking"))
    slice_of = F.pmod(F.xxhash64("id", F.lit(1)), F.col("slices")).cast("int").alias("slice")
    # The pairs are at most MOST_PIVOTS**2 plus one row for each block.
    asked = queries.join(F.broadcast(pairs), "asking").select("grp", slice_of, "cell", "part", "id", "v", "floor")
    blocks = pairs.groupBy("grp", "cell", "parts").agg(F.max("slices").alias("slices"))
    part_of = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")
    stored = placed.select("id", "v", "cell").join(F.broadcast(blocks), "cell").select(
        "grp", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "cell", part_of, "id", "v"
    )
    tile = ["grp", "slice", "cell", "part"]
    return renewed(asked).groupBy(*tile).cogroup(stored.groupBy(*tile)).applyInPandas(_tile(k), "query_id bigint, vec_id bigint, score bigint")
