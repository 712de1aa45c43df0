"""Reversible line deduplication: sharded cuckoo filters backed by exact reference counts.

1. A line's key is the line without white space at its ends, A-Z lower-cased. The reference-count
   table says exactly in how many documents of the index a key stands. It is a list of written runs:
   inserting documents appends a run of positive counts, deleting documents one of negative counts,
   and the count of a key is their sum. Runs are merged when there are ``MOST_RUNS`` of them.
2. Keys that reach the threshold stand in a cuckoo filter, one filter for each shard of the key space.
   A change touches a filter only with the keys that cross the threshold: upwards they are added,
   downwards taken out. A filter that overflows is built again from the counts of its shard.
3. Texts are cleaned in one pass against the broadcast filters. A filter answers yes for every key
   that reached the threshold and, once in about 2**29 keys, for another; those others are found
   beforehand from the counts and sent along, so the result is exact. Where filters or exceptions are
   too large to send, lines are joined with the counts instead.

A key is known by 128 bits of its BLAKE2b digest.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.staging import stage

WHITE = b" \t\n\x0b\x0c\r"
#: Keys that a task counts before it hands them on.
BUFFER_KEYS = 200_000
#: Frequent keys of a shard, about.
SHARD_KEYS = 1 << 16
MOST_RUNS = 8
#: Filters and exceptions are sent to the workers up to this size; beyond, lines are joined.
BROADCAST_BYTES = 64 << 20
#: Parts into which the lines of one key are dealt in the join.
SALTS = 16
_KEY_BYTES = 16
_SLOTS = 4
_LOAD = 0.8
_KICKS = 500


class FilterFull(Exception):
    """A key found no place; the filter must be built again, larger."""


class CuckooFilter:
    """Fingerprints of 32 bits in buckets of four; every key has two buckets.

    Keys are given as rows of four 32-bit numbers: the second names the bucket, the third is the
    fingerprint. Only keys that were added may be removed.
    """

    def __init__(self, slots: np.ndarray) -> None:
        self.slots = slots

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(1, int(np.ceil(keys / _LOAD / _SLOTS)) - 1).bit_length()
        return cls(np.zeros((buckets, _SLOTS), dtype=np.uint32))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, dtype=np.uint32).reshape(-1, _SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        spread = (mark.astype(np.uint64) * np.uint64(0x5BD1E995)) >> np.uint64(7)
        return bucket ^ (spread & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = np.maximum(keys[:, 2], np.uint32(1))
        first = (keys[:, 1] & np.uint32(len(self.slots) - 1)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, first, second = self._places(keys)
        return ((self.slots[first] == mark[:, None]) | (self.slots[second] == mark[:, None])).any(axis=1)

    def add(self, keys: np.ndarray) -> None:
        """Add distinct keys that are not in the filter."""
        mark, first, second = self._places(keys)
        left = np.arange(len(keys))
        for bucket in (first, second):
            left = left[~self._settled(bucket[left], mark[left])]
        draw = np.random.default_rng(len(keys))
        for i in left:
            self._kick(int(second[i]), mark[i], draw)

    def _settled(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Put marks into free slots of their buckets, all at once; true for those that got one."""
        order = np.argsort(bucket, kind="stable")
        sorted_bucket = bucket[order]
        head = np.searchsorted(sorted_bucket, sorted_bucket, side="left")
        place = np.arange(len(order)) - head
        free = self.slots[sorted_bucket] == 0
        rank = np.cumsum(free, axis=1) - 1
        chosen = free & (rank == place[:, None])
        fits = chosen.any(axis=1)
        self.slots[sorted_bucket[fits], chosen[fits].argmax(axis=1)] = mark[order[fits]]
        settled = np.zeros(len(order), dtype=bool)
        settled[order[fits]] = True
        return settled

    def _kick(self, bucket: int, mark: np.uint32, draw: np.random.Generator) -> None:
        for _ in range(_KICKS):
            free = np.flatnonzero(self.slots[bucket] == 0)
            if len(free):
                self.slots[bucket, free[0]] = mark
                return
            slot = int(draw.integers(_SLOTS))
            mark, self.slots[bucket, slot] = self.slots[bucket, slot], mark
            bucket = int(self._other(np.array([bucket]), np.array([mark]))[0])
        raise FilterFull

    def remove(self, keys: np.ndarray) -> None:
        for mark, first, second in zip(*self._places(keys), strict=True):
            for bucket in (first, second):
                at = np.flatnonzero(self.slots[bucket] == mark)
                if len(at):
                    self.slots[bucket, at[0]] = 0
                    break


def filter_of(keys: np.ndarray) -> CuckooFilter:
    """A filter with room for the keys, doubled until they fit."""
    room = len(keys)
    while True:
        built = CuckooFilter.sized(room)
        try:
            built.add(keys)
            return built
        except FilterFull:
            room *= 2


@dataclass(frozen=True)
class LineIndex:
    """An immutable state. ``runs`` have (key, refs), ``filters`` one row (shard, filter) for each shard in use."""

    runs: tuple[DataFrame, ...]
    filters: DataFrame
    shard_bits: int
    min_docs: int
    min_chars: int


# -- keys of lines ------------------------------------------------------------------------------


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The digest of a line's key; none if the key is shorter than ``min_chars`` code points."""
    key = line.strip(WHITE).lower()
    if len(key) < min_chars or (min_chars > 1 and sum(b & 0xC0 != 0x80 for b in key) < min_chars):
        return None
    return blake2b(key, digest_size=_KEY_BYTES).digest() if key else None


def _numbers(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype="<u4").reshape(-1, 4)


def _shard_numbers(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys.view(">u2").reshape(-1, 8)[:, 0].astype(np.int64) >> (16 - bits)


def _shard(bits: int) -> Column:
    """The shard of a key, from its first two bytes."""
    return F.shiftright(F.conv(F.hex(F.substring("key", 1, 2)), 16, 10).cast("int"), 16 - bits)


def _counted(min_chars: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], names=["key", "refs"]
            )
            found.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                keys = {line_key(line, min_chars) for line in (text.as_py() or b"").split(b"\n")}
                keys.discard(None)
                found.update(keys)
                if len(found) >= BUFFER_KEYS:
                    yield flushed()
        yield flushed()

    return count


def line_references(docs: DataFrame, text: str = "text", min_chars: int = 1) -> DataFrame:
    """``(key, refs)``: in how many rows of ``docs`` a key stands. A row counts a key once."""
    rows = docs.select(F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(_counted(min_chars), "key binary, refs bigint").groupBy("key").agg(F.sum("refs").alias("refs"))


# -- the index ----------------------------------------------------------------------------------


def references(index: LineIndex) -> DataFrame:
    """The exact counts ``(key, refs)`` of the index."""
    rows = index.runs[0]
    if len(index.runs) == 1:
        return rows
    for run in index.runs[1:]:
        rows = rows.unionByName(run)
    return rows.groupBy("key").agg(F.sum("refs").alias("refs")).filter("refs <> 0")


def _built(group: pd.DataFrame) -> pd.DataFrame:
    keys = _numbers(group["key"].tolist())
    return pd.DataFrame({"shard": group["shard"].iloc[:1], "filter": [filter_of(keys).to_bytes()]})


def _filters(counts: DataFrame, bits: int, min_docs: int) -> DataFrame:
    frequent = counts.filter(F.col("refs") >= min_docs).select(_shard(bits).alias("shard"), "key")
    return frequent.groupBy("shard").applyInPandas(_built, "shard int, filter binary")


def _indexed(counts: DataFrame, min_docs: int, min_chars: int) -> LineIndex:
    frequent = counts.filter(F.col("refs") >= min_docs).count()
    bits = min(16, max(0, -(-frequent // SHARD_KEYS) - 1).bit_length())
    filters = stage(_filters(counts, bits, min_docs), "line-filters")
    return LineIndex((counts,), filters, bits, min_docs, min_chars)


def build_index(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text") -> LineIndex:
    """An index of all lines of ``docs``, one document a row. Null and empty texts add no key; no rows give an empty index."""
    if min_docs < 1 or min_chars < 1:
        raise ValueError("min_docs and min_chars must be positive")
    return _indexed(stage(line_references(docs, text, min_chars), "line-counts"), min_docs, min_chars)


def _updated(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The filter of one shard after the keys that crossed the threshold; null if they found no place."""
    data = left["filter"].iloc[0] if len(left) else None
    if not len(right):
        return pd.DataFrame({"shard": left["shard"], "filter": [data]})
    added = right["added"].to_numpy(dtype=bool)
    keys = _numbers(right["key"].tolist())
    state = CuckooFilter.from_bytes(data) if data is not None else CuckooFilter.sized(int(added.sum()))
    state.remove(keys[~added])
    try:
        state.add(keys[added])
        data = state.to_bytes()
    except FilterFull:
        data = None
    return pd.DataFrame({"shard": right["shard"].iloc[:1], "filter": [data]})


def _changed(index: LineIndex, docs: DataFrame, text: str, sign: int) -> LineIndex:
    counted = line_references(docs, text, index.min_chars)
    run = stage(counted.select("key", (F.col("refs") * sign).alias("refs")), "line-run")
    change = run.withColumnRenamed("refs", "change")
    touched = change.join(references(index), "key", "left").select("key", "change", F.coalesce("refs", F.lit(0)).alias("refs"))
    if sign < 0 and not touched.filter("refs + change < 0").isEmpty():
        raise ValueError("documents to delete are not in the index")
    before, after = F.col("refs") >= index.min_docs, F.col("refs") + F.col("change") >= index.min_docs
    crossed = touched.filter(before != after).select(_shard(index.shard_bits).alias("shard"), "key", after.alias("added"))
    filters = stage(
        index.filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(_updated, "shard int, filter binary"),
        "line-filters",
    )
    changed = replace(index, runs=(*index.runs, run), filters=filters)
    if len(changed.runs) > MOST_RUNS:
        return _indexed(stage(references(changed), "line-counts"), index.min_docs, index.min_chars)
    full = filters.filter("filter is null").select("shard")
    if not full.isEmpty():
        again = _filters(references(changed), index.shard_bits, index.min_docs).join(full, "shard", "left_semi")
        changed = replace(changed, filters=stage(filters.filter("filter is not null").unionByName(again), "line-filters"))
    return changed


def insert_documents(index: LineIndex, docs: DataFrame, text: str = "text") -> LineIndex:
    """The index with the rows of ``docs`` added; the given index stays as it was."""
    return _changed(index, docs, text, 1)


def delete_documents(index: LineIndex, docs: DataFrame, text: str = "text") -> LineIndex:
    """The index without the rows of ``docs``, which give the texts as they were inserted.

    Undoes an insertion: counts, and therefore all later decisions, are what they were without those
    documents. A line that was never inserted, or fewer times, raises an error.
    """
    return _changed(index, docs, text, -1)


# -- cleaning -----------------------------------------------------------------------------------


def _hits(filters: dict[int, CuckooFilter], bits: int, keys: list[bytes]) -> np.ndarray:
    """Which keys a filter answers yes for."""
    numbers = _numbers(keys)
    shards = _shard_numbers(numbers, bits)
    hit = np.zeros(len(keys), dtype=bool)
    for shard in np.unique(shards).tolist() if bits else [0]:
        if shard in filters:
            here = np.flatnonzero(shards == shard)
            hit[here] = filters[shard].contains(numbers[here])
    return hit


def _opened(packed: dict[int, bytes]) -> dict[int, CuckooFilter]:
    return {shard: CuckooFilter(np.frombuffer(data, dtype=np.uint32).reshape(-1, _SLOTS)) for shard, data in packed.items()}


def _false_hits(filters, bits: int) -> Callable:
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = _opened(filters.value)
        for batch in batches:
            if len(batch):
                keys = batch.column(0).to_pylist()
                yield batch.filter(pa.array(_hits(opened, bits, keys)))

    return test


def _cleaned(filters, exceptions, bits: int, min_chars: int, schema: pa.Schema) -> Callable:
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, spared = _opened(filters.value), exceptions.value
        for batch in batches:
            texts = [(t.as_py() or b"").split(b"\n") for t in batch.column(1)]
            keys = [line_key(line, min_chars) for lines in texts for line in lines]
            known = [k for k in keys if k is not None]
            hit = iter(_hits(opened, bits, known).tolist() if known else ())
            dropped = iter([k is not None and next(hit) and k not in spared for k in keys])
            kept = [[line for line in lines if not next(dropped)] for lines in texts]
            counts = [len(lines) for lines in texts]
            gone = [n - len(lines) for n, lines in zip(counts, kept, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(map(b"\n".join, kept), pa.binary())],
                names=schema.names,
            )

    return clean


def clean_documents(index: LineIndex, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the key, ``n_lines`` before dropping, ``n_dropped``, ``kept`` text.

    Lines whose key stands in at least ``min_docs`` documents of the index are dropped; the others stay
    as they are, joined by a line feed. The documents must be in the index. Null and empty texts are one
    empty line, which stays; lines without a key stay. Rows are decided one by one, whatever their key:
    null and repeated keys give as many rows. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key), F.col(text).cast("binary").alias("_text"))
    size = index.filters.agg(F.sum(F.length("filter"))).first()[0] or 0
    if size > BROADCAST_BYTES:
        return clean_by_join(index, docs, key, text)
    filters = spark.sparkContext.broadcast({r["shard"]: bytes(r["filter"]) for r in index.filters.collect()})
    rare = references(index).filter(F.col("refs") < index.min_docs).select("key")
    false = stage(rare.mapInArrow(_false_hits(filters, index.shard_bits), "key binary"), "line-exceptions")
    if false.count() * _KEY_BYTES > BROADCAST_BYTES:
        return clean_by_join(index, docs, key, text)
    exceptions = spark.sparkContext.broadcast({bytes(r["key"]) for r in false.collect()})
    schema = f"`{key}` {dict(docs.dtypes)[key]}, n_lines bigint, n_dropped bigint, kept binary"
    names = pa.schema([(n, pa.null()) for n in (key, "n_lines", "n_dropped", "kept")])
    found = rows.mapInArrow(_cleaned(filters, exceptions, index.shard_bits, index.min_chars, names), schema)
    return found.withColumn("kept", F.col("kept").cast("string"))


def _lines(min_chars: int) -> Callable:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                lines = (text.as_py() or b"").split(b"\n")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row] * len(lines), pa.int64()),
                        pa.array(range(len(lines)), pa.int32()),
                        pa.array(lines, pa.binary()),
                        pa.array([line_key(line, min_chars) for line in lines], pa.binary()),
                    ],
                    names=["row", "place", "line", "key"],
                )

    return split


def clean_by_join(index: LineIndex, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``clean_documents`` by a join of all lines with the counts, for filters of any size.

    The lines of one key are dealt into ``SALTS`` parts, so a line that stands in most documents is no
    single task's work.
    """
    numbered = stage(docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("name"), F.col(text).cast("binary").alias("text")), "line-rows")
    lines = numbered.select("row", "text").mapInArrow(_lines(index.min_chars), "row bigint, place int, line binary, key binary")
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    frequent = references(index).filter(F.col("refs") >= index.min_docs).select("key", every, F.lit(True).alias("drop"))
    judged = salted.join(frequent, ["key", "salt"], "left").withColumn("keep", F.col("drop").isNull())
    kept = F.array_sort(F.collect_list(F.when(F.col("keep"), F.struct("place", F.col("line").cast("string").alias("line")))))
    whole = judged.groupBy("row").agg(
        F.count("*").alias("n_lines"),
        F.count("drop").alias("n_dropped"),
        F.array_join(F.transform(kept, lambda x: x["line"]), "\n").alias("kept"),
    )
    return numbered.select("row", F.col("name").alias(key)).join(whole, "row").select(key, "n_lines", "n_dropped", "kept")
