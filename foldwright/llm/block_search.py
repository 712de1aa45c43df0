"""Nearest neighbours by a block matrix join with int8 products.

Queries and rows are dealt into blocks by a hash of their id, and each pair of blocks is one tile.
In a tile both sides are quantised to int8; their product gives every inner product within an error
bound from the quantisation residuals. A pair survives if its upper bound reaches the query's worst
kth value, is then computed again in double precision, and enters the query's heap. So nothing that
could be among the nearest is lost. Spark merges the heaps of the tiles.
"""

from __future__ import annotations

from heapq import heappush, heappushpop

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.llm.vectors import best, block_count, finite, one_row_per_id, parallel_parts, renewed, stacked
from foldwright.staging import stage

MOST_ROWS = 16_384
LEAST_ROWS = 256
_STEP_QUERIES, _STEP_ROWS = 512, 2048
#: So many int8 products add up without error in single precision.
_EXACT = (1 << 24) // (127 * 127)


class _Quantised:
    """int8 vectors with their scale, the length of the residual, and the lengths of both forms."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.scale = np.maximum(np.abs(vectors).max(axis=1), np.finfo(np.float64).tiny) / 127
        self.codes = np.rint(vectors / self.scale[:, None]).astype(np.int8)
        near = self.codes * self.scale[:, None]
        self.error = np.linalg.norm(vectors - near, axis=1)
        self.length = np.linalg.norm(vectors, axis=1)
        self.near_length = np.linalg.norm(near, axis=1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of two int8 tiles."""
    total = np.zeros((len(a), len(b)))
    for start in range(0, a.shape[1], _EXACT):
        part = slice(start, start + _EXACT)
        total += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return total


def _in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, summed from the first component to the last."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def tile_nearest(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple]:
    """``(query, id, score)`` of up to k rows per query, every one that belongs to its k nearest included."""
    asked, stored = _Quantised(queries), _Quantised(rows)
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    worst = np.full(len(query_ids), -np.inf)
    for q in range(0, len(query_ids), _STEP_QUERIES):
        some = slice(q, q + _STEP_QUERIES)
        for r in range(0, len(ids), _STEP_ROWS):
            part = slice(r, r + _STEP_ROWS)
            middle = _products(asked.codes[some], stored.codes[part]) * asked.scale[some, None] * stored.scale[part]
            bound = np.outer(asked.error[some], stored.length[part]) + np.outer(asked.near_length[some], stored.error[part])
            bound += 1e-9 * np.outer(asked.length[some], stored.length[part])
            own = query_ids[some, None] == ids[part]
            lower = np.where(own, -np.inf, middle - bound)
            if lower.shape[1] >= k:
                kth = np.partition(lower, -k, axis=1)[:, -k]
                worst[some] = np.maximum(worst[some], kth)
            i, j = np.nonzero((middle + bound >= worst[some, None]) & ~own)
            exact = _in_order(queries[i + q], rows[j + r])
            for at, name, score in zip((i + q).tolist(), ids[j + r].tolist(), exact.tolist(), strict=True):
                heap = heaps[at]
                if len(heap) < k:
                    heappush(heap, (score, -name))
                elif (score, -name) > heap[0]:
                    heappushpop(heap, (score, -name))
            for at in range(q, min(q + _STEP_QUERIES, len(query_ids))):
                if len(heaps[at]) == k:
                    worst[at] = max(worst[at], heaps[at][0][0])
    return [(int(query), -name, score) for query, heap in zip(query_ids, heaps, strict=True) for score, name in heap]


def _tile(k: int):
    def tile(asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asked) and len(stored):
            sides = [(t["id"].to_numpy(), stacked(t["v"]).astype(np.float64)) for t in (asked, stored)]
            found = tile_nearest(*sides[0], *sides[1], k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    return tile


def nearest_by_product(
    vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", most_rows: int = MOST_ROWS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k rows with the largest inner product.

    ``is_query`` is a condition on column ``id`` (the key as a long). A query's own row is no candidate;
    ties go to the smaller id; with fewer candidates all are returned. Vectors that are null, empty,
    all zero or hold null or non-finite components take no part, nor do rows without an id; an id that
    occurs again is one row with its smallest vector. Vectors of different lengths do not meet.
    """
    usable = vectors.filter(finite(vector) & F.exists(vector, lambda x: x != 0))
    rows = stage(one_row_per_id(usable, key, vector).withColumn("dim", F.size("v")), "vectors")
    queries = rows.filter(is_query)
    parts = parallel_parts(rows)
    across = block_count(rows.count(), most_rows, LEAST_ROWS, parts)
    down = block_count(queries.count(), most_rows, most_rows, 1)
    tile = ["dim", "down", "across"]
    asked = queries.withColumns(
        {"down": F.pmod(F.xxhash64("id", F.lit(1)), F.lit(down)), "across": F.explode(F.sequence(F.lit(0), F.lit(across - 1)))}
    )
    stored = rows.withColumns(
        {"across": F.pmod(F.xxhash64("id"), F.lit(across)).cast("int"), "down": F.explode(F.sequence(F.lit(0), F.lit(down - 1)).cast("array<bigint>"))}
    )
    found = renewed(asked).groupBy(*tile).cogroup(stored.groupBy(*tile)).applyInPandas(_tile(k), "query_id bigint, vec_id bigint, score double")
    return best(found, k)
