"""Contiguous shards of nearly equal bytes from global prefix sums.

The rows are put in order of their key by ranges. Each range sums its own sizes while it streams
through one task; only one total per range is added up across ranges. A row goes to the shard in
which the middle of its bytes falls, so every shard is within one row of the target.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwright.llm.common import utf8_size
from foldwright.staging import stage

ROW_OVERHEAD = 8


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Bytes and rows before each row of a sorted range; keeps two numbers between batches."""
    span, size, rows = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        total = batch["size"].cumsum()
        batch["span"] = span
        batch["bytes_in"] = size + total - batch["size"]
        batch["rows_in"] = range(rows, rows + len(batch))
        if len(batch):
            size, rows = size + int(total.iloc[-1]), rows + len(batch)
        yield batch


def shard_by_bytes(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the key, ``size, text_crc32, shard, slot, bytes_before``.

    Shards are contiguous in the order of (key, crc, size), null keys first. ``size`` is the UTF-8
    bytes plus a fixed overhead, so that empty texts count too; a null text has no bytes and the
    crc of an empty one. Repeated rows are kept; they take neighbouring places, and a key that
    holds most rows is cut like any other, since the input position ends the sort key. Texts stay
    where they are: only ids, sizes and checksums are shuffled. An empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    sized = docs.select(
        F.col(key),
        (utf8_size(text) + ROW_OVERHEAD).alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.monotonically_increasing_id().alias("position"),
    )
    order = [F.col(key).asc_nulls_first(), F.col("text_crc32"), F.col("size"), F.col("position")]
    ranged = sized.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = dict(sized.dtypes)[key]
    columns = f"`{key}` {kind}, size bigint, text_crc32 bigint, position bigint, span int, bytes_in bigint, rows_in bigint"
    placed = stage(ranged.mapInPandas(_running, columns).drop("position"), "shard-ranges")

    spans = placed.groupBy("span").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = spans.select(
        "span",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_at"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_at"),
        F.sum("bytes").over(whole).alias("total"),
    )
    middle = F.expr(f"(2 * (bytes_in + bytes_at) + size) * {shards} div (2 * total)")
    # One row per range: as many as the exchange above has partitions.
    cut = placed.join(F.broadcast(offsets), "span").select(
        key,
        "size",
        "text_crc32",
        F.least(middle, F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("rows_in") + F.col("rows_at")).alias("row"),
        (F.col("bytes_in") + F.col("bytes_at")).alias("bytes_before"),
    )
    starts = cut.groupBy("shard").agg(F.min("row").alias("start"))
    # One row per shard.
    return cut.join(F.broadcast(starts), "shard").select(
        key, "size", "text_crc32", "shard", (F.col("row") - F.col("start")).alias("slot"), "bytes_before"
    )


def write_shards(docs: DataFrame, shards: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write the documents as one folder per shard. ``key`` must be unique; rows join by it once."""
    placed = docs.join(shards.select(key, "shard", "slot"), key)
    placed.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
