"""Maximal periodic runs of words, found scale by scale in overlapping tiles.

A run is a stretch of words in which words q apart are identical, q its smallest period, that is at
least ``MIN_EXPONENT`` periods long and that no neighbouring word extends. In terms of matches (places i
with word i equal to word i + q) it is an interval of at least two periods.

1. Periods are treated by octaves [A, 2A); the shortest ones form one octave. Boundaries stand every A
   words. An interval of an octave covers the A words behind one of its boundaries at least, so rolling
   hashes of A words, compared between a boundary and the octave's distances from it, name the
   boundaries and periods worth a look; a whole batch of documents is compared at once.
2. A tile is the words around its boundaries: A to the left, 2A and a period to the right. It is solved on
   its own. At a boundary one Z-function over the words behind it and one over the reversed words before
   it give the reach of every period to both sides, and tell which periods are powers of a smaller one.
3. What is found are fragments of intervals, cut at the tile's edge. They are shuffled by document and
   period, and fragments that touch are stitched.

The tiles of a long document are dealt to all tasks; those of a shorter one are solved where it was
read, since moving them would cost more than solving them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwright.llm.common import mixed
from foldwright.staging import stage

MIN_EXPONENT = 3
MIN_LENGTH = 24
#: Documents with more words have their tiles dealt to all tasks.
SPREAD_WORDS = 8192
#: Boundaries of a tile that is dealt.
TILE_BOUNDARIES = 64
#: Words that are hashed at once, or one longer document.
_PIECE = 1 << 17
#: Comparisons of a step.
_CELLS = 1 << 20
_BASE = 0x9E3779B97F4A7C15

_DOCUMENT, _FRAGMENT, _TILE = 0, 1, 2
_FRAGMENTS = "uid bigint, period bigint, start bigint, end bigint"


def octaves(words: int, min_length: int) -> Iterator[tuple[int, int, int]]:
    """``(block, low, high)``: periods low..high-1 and the distance of boundaries, up to a third of the words."""
    block = 1
    while 6 * block - 2 <= min_length:
        block *= 2
    if block > 1:
        yield block, 1, block
    while MIN_EXPONENT * block <= words:
        yield block, block, 2 * block
        block *= 2


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    forward, backward = (np.full(size, base, dtype=np.uint64) for base in (_BASE, pow(_BASE, -1, 1 << 64)))
    forward[0] = backward[0] = 1
    return np.cumprod(forward), np.cumprod(backward)


def boundary_hits(sums: np.ndarray, ends: np.ndarray, octave: tuple[int, int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(boundary, period)`` where the block behind a boundary stands again a period later in the same document.

    ``sums`` are running hashes of the words, ``ends`` the ends of the documents in them.
    Equal blocks are always found; unequal ones with equal hashes do no harm.
    """
    block, low, high = octave
    total = int(ends[-1])
    if total <= block:
        return
    _, backward = _powers(1 << max(18, total.bit_length()))
    blocks = (sums[block : total + 1] - sums[: total + 1 - block]) * backward[: total + 1 - block]
    at = np.arange(0, len(blocks), block)
    limit = ends[np.searchsorted(ends, at, side="right")] - block
    at, limit = at[at + low <= limit], limit[at + low <= limit]
    apart = np.arange(low, high)
    step = max(1, _CELLS // len(apart))
    for first in range(0, len(at), step):
        place = at[first : first + step, None] + apart
        inside = place <= limit[first : first + step, None]
        equal = blocks[np.minimum(place, len(blocks) - 1)] == blocks[at[first : first + step], None]
        row, column = np.nonzero(equal & inside)
        if len(row):
            yield at[first + row], apart[column]


def z_function(sequence: list[int]) -> list[int]:
    """For each place the length of the longest common prefix of the sequence and its rest from there."""
    size = len(sequence)
    reach = [0] * size
    left = right = 0
    for i in range(1, size):
        k = min(right - i, reach[i - left]) if i < right else 0
        while i + k < size and sequence[k] == sequence[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        reach[i] = k
    return reach


def boundary_fragments(words: list[int], at: int, periods: list[int], octave: tuple[int, int, int]) -> Iterator[tuple[int, int, int]]:
    """``(period, start, end)``: intervals of matches around one boundary, as far as its tile reaches.

    Periods that are powers of a smaller one are left out: they are the same stretch.
    """
    block, _, high = octave
    behind = z_function(words[at : at + 2 * block + high])
    before = words[max(0, at - block) : at][::-1]
    ahead = words[max(0, at - block) : at + high][::-1]
    back = z_function([*before, -1, *ahead])
    last = min(len(words), at + high) - at + len(before) + 1
    powers = set()
    for root in range(1, high // 2 + 1):
        if root < len(behind) and behind[root] >= root and root not in powers:
            powers.update(range(2 * root, min(high, behind[root] + root + 1), root))
    for period in periods:
        if period not in powers:
            yield period, at - back[last - period], at + min(behind[period], 2 * block)


def solved(words: list[int], hits: list[tuple[int, list[int]]], octave: tuple[int, int, int], least: Callable, edges: tuple[int, int]) -> Iterator[tuple[int, int, int]]:
    """The fragments of a tile, those of neighbouring boundaries joined. ``edges`` are where the tile ends.

    An interval that reaches no edge is whole, and is left out if it is shorter than a run's.
    """
    open_: dict[int, list[int]] = {}

    def whole(period: int, start: int, end: int) -> bool:
        return start > edges[0] and end < edges[1] and end - start < least(period)

    for at, periods in hits:
        for period, start, end in boundary_fragments(words, at, periods, octave):
            held = open_.get(period)
            if held and start <= held[1]:
                held[1] = max(held[1], end)
                continue
            if held and not whole(period, *held):
                yield period, held[0], held[1]
            open_[period] = [start, end]
    for period, (start, end) in open_.items():
        if not whole(period, start, end):
            yield period, start, end


def _least(min_length: int) -> Callable:
    return lambda period: max(min_length, MIN_EXPONENT * period) - period


def _stretches(values: np.ndarray) -> list[slice]:
    """The stretches of equal neighbours; values are not negative."""
    cuts = [*np.flatnonzero(np.diff(values, prepend=-1)).tolist(), len(values)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


def _grouped(at: np.ndarray, periods: np.ndarray) -> list[tuple[int, list[int]]]:
    """The periods of each boundary."""
    return [(int(at[here.start]), periods[here].tolist()) for here in _stretches(at)]


class _Rows:
    """Rows of one kind each: documents, fragments, tiles."""

    def __init__(self, key_type: pa.DataType) -> None:
        self.schema = pa.schema(
            [
                ("kind", pa.int32()),
                ("uid", pa.int64()),
                ("key", key_type),
                ("size", pa.int64()),
                ("block", pa.int64()),
                ("low", pa.int64()),
                ("high", pa.int64()),
                ("period", pa.int64()),
                ("start", pa.int64()),
                ("end", pa.int64()),
                ("core", pa.int64()),
                ("data", pa.binary()),
                ("marks", pa.binary()),
                ("collapsed", pa.binary()),
            ]
        )
        self.columns: list[list] = [[] for _ in self.schema]

    def add(self, **values) -> None:
        for column, name in zip(self.columns, self.schema.names, strict=True):
            column.append(values.get(name))

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.array(c, t) for c, t in zip(self.columns, self.schema.types, strict=True)]
        self.columns = [[] for _ in self.schema]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _finished(words: list[bytes], digest: bool) -> bytes:
    whole = b" ".join(words)
    return hashlib.sha256(whole).hexdigest().encode() if digest else whole


def _piece(docs: list[tuple[int, object, list[bytes]]], rows: _Rows, min_length: int, spread: int, digest: bool) -> None:
    """Find fragments and tiles in the documents of a piece, longest first, all at once for each octave."""
    docs = sorted(docs, key=lambda d: -len(d[2]))
    names: dict[bytes, int] = {}
    lengths = np.array([len(words) for _, _, words in docs], dtype=np.int64)
    ends = np.cumsum(lengths)
    codes = np.fromiter((names.setdefault(w, len(names)) for _, _, words in docs for w in words), dtype=np.int64, count=int(ends[-1]))
    forward, _ = _powers(1 << max(18, len(codes).bit_length()))
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(mixed(codes.astype(np.uint64) + np.uint64(_BASE)) * forward[: len(codes)], out=sums[1:])
    least, touched = _least(min_length), set()
    lists: dict[int, list[int]] = {}

    for octave in octaves(int(lengths[0]), min_length):
        block, low, high = octave
        active = int(np.searchsorted(-lengths, -max(min_length, MIN_EXPONENT * low), side="right"))
        if not active:
            break
        found = list(boundary_hits(sums, ends[:active], octave))
        if not found:
            continue
        at, periods = (np.concatenate(x) for x in zip(*found, strict=True))
        owner = np.searchsorted(ends, at, side="right")
        for here in _stretches(owner):
            d = int(owner[here.start])
            begin, size = int(ends[d] - lengths[d]), int(lengths[d])
            places, uid = at[here] - begin, docs[d][0]
            if size > spread:
                tile = at[here] // (block * TILE_BOUNDARIES)
                for part in _stretches(tile):
                    core = int(tile[part.start]) * block * TILE_BOUNDARIES - begin
                    start = max(0, core - block)
                    end = min(size, core + block * (TILE_BOUNDARIES + 2) + high)
                    data = codes[begin + start : begin + end].astype(np.int32)
                    marks = np.stack([places[part] - start, periods[here][part]])
                    rows.add(
                        kind=_TILE, uid=uid, block=block, low=low, high=high, start=start, core=core, data=data.tobytes(), marks=marks.tobytes()
                    )
                touched.add(d)
                continue
            if d not in lists:
                lists[d] = codes[begin : begin + size].tolist()
            for period, start, end in solved(lists[d], _grouped(places, periods[here]), octave, least, (-1, size + 1)):
                rows.add(kind=_FRAGMENT, uid=uid, period=period, start=start, end=end)
                touched.add(d)

    for d, (uid, key, words) in enumerate(docs):
        if d in touched:
            rows.add(kind=_DOCUMENT, uid=uid, key=key, size=len(words), data=b" ".join(words))
        else:
            rows.add(kind=_DOCUMENT, uid=uid, key=key, size=len(words), collapsed=_finished(words, digest))


def _searched(min_length: int, spread: int, digest: bool) -> Callable:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = _Rows(batch.schema.field(0).type)
            docs, size = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or b"").split()
                if docs and size + len(words) > _PIECE:
                    _piece(docs, rows, min_length, spread, digest)
                    yield rows.batch()
                    docs, size = [], 0
                docs.append((uid, key, words))
                uid, size = uid + 1, size + len(words)
            if docs:
                _piece(docs, rows, min_length, spread, digest)
                yield rows.batch()

    return search


def _tiles_solved(min_length: int) -> Callable:
    names = ["uid", "period", "start", "end"]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = _least(min_length)
        for batch in batches:
            found = []
            for tile in batch.to_pylist():
                octave = (tile["block"], tile["low"], tile["high"])
                words = np.frombuffer(tile["data"], dtype=np.int32).tolist()
                at, periods = np.frombuffer(tile["marks"], dtype=np.int64).reshape(2, -1)
                core = tile["core"] - tile["start"]
                edges = (core - octave[0], core + octave[0] * (TILE_BOUNDARIES + 1))
                for period, start, end in solved(words, _grouped(at, periods), octave, least, edges):
                    found.append((tile["uid"], period, start + tile["start"], end + tile["start"]))
            columns = zip(*found, strict=True) if found else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=names)

    return solve


def stitched(fragments: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """Runs ``(uid, start, period, length)`` from fragments of intervals: those of a document and period that touch are one."""
    group = Window.partitionBy("uid", "period").orderBy("start", "end")
    reach = F.max("end").over(group.rowsBetween(Window.unboundedPreceding, -1))
    opened = fragments.withColumn("opens", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    numbered = opened.withColumn("island", F.sum("opens").over(group.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("uid", "period", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    runs = whole.select("uid", "start", "period", (F.col("end") - F.col("start") + F.col("period")).alias("length"))
    return runs.filter(F.col("length") >= F.greatest(F.lit(min_length), F.col("period") * MIN_EXPONENT))


def kept_words(words: list[bytes], runs: list[dict]) -> list[bytes]:
    """The words outside all runs, and the first period of each run as far as no other run drops it."""
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for run in runs:
        edge[run["start"] + run["period"]] += 1
        edge[run["start"] + run["length"]] -= 1
    keep = np.cumsum(edge)[:-1] == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def _collapsed(digest: bool) -> Callable:
    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [
                _finished(kept_words(data.split(), runs or []), digest)
                for data, runs in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(done, pa.binary())], names=["key", "size", "runs", "collapsed"])

    return collapse


def periodic_runs(
    docs: DataFrame, min_length: int = MIN_LENGTH, key: str = "doc_id", text: str = "text", digest: bool = False, spread: int = SPREAD_WORDS
) -> DataFrame:
    """One row per document: ``key, n_words, runs, collapsed``.

    ``runs`` is an array of (start, period, length) in that order, in words. ``collapsed`` is the text
    without the words that a run repeats after its first period, joined by single spaces, or with
    ``digest`` its lowercase SHA-256. Words are runs of anything but the six ASCII spaces and are compared
    as they are. Null and empty texts have no words and no runs. Rows are decided one by one, whatever
    their key, so null and repeated keys give as many rows; other columns are not read. No rows in, no
    rows out. ``spread`` only says where tiles are solved.
    """
    if min_length < 1:
        raise ValueError("min_length must be positive")
    kind = dict(docs.dtypes)[key]
    columns = (
        f"kind int, uid bigint, key {kind}, size bigint, block bigint, low bigint, high bigint, "
        "period bigint, start bigint, end bigint, core bigint, data binary, marks binary, collapsed binary"
    )
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    found = stage(rows.mapInArrow(_searched(min_length, spread, digest), columns), "period-tiles", by="kind")
    documents = found.filter(F.col("kind") == _DOCUMENT)
    near = found.filter(F.col("kind") == _FRAGMENT).select("uid", "period", "start", "end")
    tiles = found.filter(F.col("kind") == _TILE).select("uid", "block", "low", "high", "start", "core", "data", "marks")
    far = tiles.repartition("uid", "low", "start").mapInArrow(_tiles_solved(min_length), _FRAGMENTS)
    runs = stitched(near.unionByName(far), min_length)
    of_document = runs.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))

    shape = "array<struct<start: bigint, period: bigint, length: bigint>>"
    quiet = documents.filter("collapsed is not null").select("key", "size", F.array().cast(shape).alias("runs"), "collapsed")
    loud = documents.filter("collapsed is null").select("uid", "key", "size", "data").join(of_document, "uid", "left")
    loud = loud.select("key", "size", F.coalesce("runs", F.array().cast(shape)).alias("runs"), "data")
    done = loud.mapInArrow(_collapsed(digest), f"key {kind}, size bigint, runs {shape}, collapsed binary")
    return quiet.unionByName(done).select(
        F.col("key").alias(key), F.col("size").alias("n_words"), "runs", F.col("collapsed").cast("string").alias("collapsed")
    )
