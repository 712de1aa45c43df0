"""N-gram Jaccard self-join through prefix trees.

Every text becomes its set of distinct word shingles in one global order. Two sets with a Jaccard
similarity of at least t share a shingle among the first ``n - ceil(t * n) + 1`` of both, so texts
meet only through those prefixes:

1. A table of hashed counts over all shingles of all texts (fixed size) puts frequent shingles last
   in the order, so that passages which many documents share do not bring them together.
2. Texts with equal sets are one class; only classes take part from here on. Prefixes are a little
   longer than needed for one common shingle: with l more, similar sets share l more. A class with
   fewer shared shingles than that is alone, and its text is not looked at again; the others leave
   the cells (see 3) in which they share least, as far as no pair can part by it.
3. Classes that share a prefix shingle belong to the cell of the smallest of them. All shingles with
   the same smallest class form one cell, so a pair of near copies meets once and not in every
   shingle they share. Large cells are cut into blocks, each with the cell's smallest class in it.
4. In a block the sets are stored in a trie, most frequent shingle first, so that near copies share
   long paths. A probe walks it once, shares the overlap counted so far between all sets below a
   node, and leaves a subtree as soon as its remaining lengths cannot reach the threshold. Pairs that
   are known to be connected are not compared.
5. Classes of a large cell that are not connected with its first class are compared with all other
   blocks of the cell, so no link is lost by cutting. Components follow from the links found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwright.llm.common import mixed
from foldwright.llm.components import connected_components
from foldwright.llm.shingles import shingle_sets
from foldwright.staging import stage

SKETCH_BITS = 20
SLICE_BITS = 12
BLOCK = 512
#: Shingles added to a prefix, in percent of the set; the more, the fewer chance meetings.
EXTRA = 10
BROADCAST_BYTES = 32 << 20
_CLASS_SHIFT = 58


# -- the global order ---------------------------------------------------------------------------


def _counted(width: int) -> Callable:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for batch in batches:
            for hashes in shingle_sets(batch["text"].tolist(), width):
                np.add.at(total, (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        if total.any():
            slices = total.reshape(-1, 1 << SLICE_BITS)
            part = TaskContext.get().partitionId()
            yield pd.DataFrame({"slice": range(len(slices)), "part": part, "counts": [s.tobytes() for s in slices]})

    return count


def _added(group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, dtype=np.int64) for c in group["counts"])
    return pd.DataFrame({"slice": [group["slice"].iloc[0]], "part": [group["part"].iloc[0] // 64], "counts": [total.tobytes()]})


def frequency_classes(texts: DataFrame, width: int) -> np.ndarray:
    """For each bucket of shingle hashes: how many times over the mean it was met, as a power of two.

    All shingles of all texts are counted. Only the table (one byte for each of 2**20 buckets) reaches
    the driver; the counts of the tasks are added up by slices, 64 tasks at a time.
    """
    schema = "slice int, part int, counts binary"
    parts = texts.mapInPandas(_counted(width), schema)
    some = parts.groupBy("slice", F.expr("part div 64").alias("at")).applyInPandas(_added, schema)
    total = np.zeros((1 << (SKETCH_BITS - SLICE_BITS), 1 << SLICE_BITS), dtype=np.int64)
    for row in some.groupBy("slice").applyInPandas(_added, schema).toLocalIterator():
        total[row["slice"]] = np.frombuffer(row["counts"], dtype=np.int64)
    flat = total.ravel()
    mean = max(1.0, flat.mean())
    return np.clip(np.floor(np.log2(np.maximum(flat, 1) / mean)), 0, 31).astype(np.uint8)


def ordered_set(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The shingles as numbers whose natural order is the global one: class first, then hash."""
    rank = classes[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    return np.sort((rank << np.uint64(_CLASS_SHIFT)) | (hashes >> np.uint64(64 - _CLASS_SHIFT)))


def _prefix_size(size: int, percent: int) -> int:
    """Two similar sets share at least ``1 + EXTRA %`` of the smaller one within prefixes of this size."""
    return min(size, size - (percent * size + 99) // 100 + 1 + size * EXTRA // 100)


def _least_shared(size: Column, percent: int) -> Column:
    """What a set of this size shares with any similar one within the prefixes, the smallest partner included."""
    return 1 + F.floor(F.ceil(size * percent / 100) * EXTRA / 100)


def _signature(hashes: np.ndarray) -> int:
    """64 bits of the whole set, whatever its order."""
    if not len(hashes):
        return 0
    folded = np.array([mixed(hashes).sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(~hashes)), len(hashes)], dtype=np.uint64)
    return int(mixed(mixed(mixed(folded[:1]) + folded[1:2]) + folded[2:]).view(np.int64)[0])


def _described(width: int, percent: int, classes) -> Callable:
    """Set size, signature and prefix of every text."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, met = classes.value, set()
        for batch in batches:
            rows = []
            for key, hashes in zip(batch["key"], shingle_sets(batch["text"].tolist(), width), strict=True):
                node = _signature(hashes)
                prefix = hashes[:0]
                if node not in met and not pd.isna(key):
                    # Copies within a task need their prefix once.
                    met.add(node)
                    prefix = ordered_set(hashes, table)[: _prefix_size(len(hashes), percent)]
                rows.append((len(hashes), node, prefix.view(np.int64)))
            made = pd.DataFrame(rows, columns=["n_shingles", "node", "prefix"])
            made.insert(0, "key", batch["key"].array)
            made.insert(1, "text_hash", batch["text_hash"].array)
            yield made

    return describe


def _set_bytes(width: int, classes) -> Callable:
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = classes.value
        for batch in batches:
            rows = [(_signature(h), ordered_set(h, table).tobytes()) for h in shingle_sets(batch["text"].tolist(), width)]
            yield pd.DataFrame(rows, columns=["node", "items"])

    return sets


# -- the trie -----------------------------------------------------------------------------------


class _Node:
    __slots__ = ("start", "end", "owner", "children", "members", "least", "most")

    def __init__(self, start: int, end: int, owner: int) -> None:
        self.start, self.end, self.owner = start, end, owner
        self.children: list[_Node] = []
        self.members: list[int] = []
        self.least, self.most = 1 << 60, 0


class PrefixTree:
    """A compressed trie over sorted rank sequences; equal beginnings are stored once."""

    def __init__(self, sequences: list[np.ndarray], members: list[int]) -> None:
        self.sequences = sequences
        self.root = _Node(0, 0, 0)
        keys = {m: sequences[m].astype(">u4").tobytes() for m in members}
        path = [self.root]
        previous = None
        for m in sorted(members, key=keys.__getitem__):
            own = sequences[m]
            shared = 0
            if previous is not None:
                size = min(len(own), len(previous))
                differ = np.flatnonzero(own[:size] != previous[:size])
                shared = int(differ[0]) if len(differ) else size
            while path[-1].start >= shared and len(path) > 1:
                path.pop()
            top = path[-1]
            if top.end > shared:
                rest = _Node(shared, top.end, top.owner)
                rest.children, rest.members = top.children, top.members
                top.end, top.children, top.members = shared, [rest], []
            if len(own) > shared:
                leaf = _Node(shared, len(own), m)
                top.children.append(leaf)
                path.append(leaf)
            path[-1].members.append(m)
            previous = own
        self._measure(self.root)

    def _measure(self, root: _Node) -> None:
        order, todo = [], [root]
        while todo:
            node = todo.pop()
            order.append(node)
            todo += node.children
        for node in reversed(order):
            sizes = [len(self.sequences[m]) for m in node.members]
            node.least = min([*sizes, *(c.least for c in node.children)], default=1 << 60)
            node.most = max([*sizes, *(c.most for c in node.children)], default=0)

    def links(self, probe: np.ndarray, percent: int, known: Callable[[int], bool], universe: int) -> Iterator[int]:
        """Members whose set reaches the similarity with ``probe``; those for which ``known`` holds are left out."""
        size = len(probe)
        inside = np.zeros(universe, dtype=np.int64)
        inside[probe] = 1
        todo = [(child, 0) for child in self.root.children]
        while todo:
            node, overlap = todo.pop()
            if 100 * node.most < percent * size or percent * node.least > 100 * size:
                continue
            path = self.sequences[node.owner][node.start : node.end]
            overlap += int(inside[path].sum())
            left = size - int(np.searchsorted(probe, path[-1], side="right"))
            reach = overlap + min(left, node.most - node.end)
            if (100 + percent) * reach < percent * (size + node.least):
                continue
            for m in node.members:
                if (100 + percent) * overlap >= percent * (size + node.end) and not known(m):
                    yield m
            todo += [(child, overlap) for child in node.children]


class _Union:
    def __init__(self, labels: list[int]) -> None:
        first: dict[int, int] = {}
        self.parent = [first.setdefault(label, i) for i, label in enumerate(labels)]

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True


def block_links(nodes: list[int], sets: list[np.ndarray], labels: list[int], probes: list[bool], stored: list[bool], percent: int) -> list:
    """Links that connect what the labels do not yet connect: pairs of nodes.

    Every pair of a probe and a stored set is either connected by labels and links, or dissimilar.
    Where all sets are both, the first probe is the smallest node, and the largest group it
    leaves behind needs no probes of its own.
    """
    every, ranks = np.unique(np.concatenate(sets), return_inverse=True) if sets else (np.zeros(0), np.zeros(0))
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    # The largest number is the most frequent shingle; it comes first.
    sequences = [np.ascontiguousarray(part[::-1]) for part in np.split(len(every) - 1 - ranks, cuts)]
    tree = PrefixTree(sequences, [i for i, s in enumerate(stored) if s])
    union, found = _Union(labels), []

    def run(i: int) -> None:
        for j in tree.links(sequences[i], percent, lambda m: union.find(m) == union.find(i), len(every)):
            if union.join(i, j):
                found.append((nodes[i], nodes[j]))

    asking = sorted((i for i, p in enumerate(probes) if p), key=nodes.__getitem__)
    if len(asking) == len(nodes) == sum(stored):
        run(asking[0])
        groups = np.array([union.find(i) for i in range(len(nodes))])
        largest = np.bincount(groups).argmax()
        asking = [i for i in asking[1:] if groups[i] != largest]
    for i in asking:
        run(i)
    return found


def _linked(percent: int) -> Callable:
    def link(group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(b, dtype=np.uint64) for b in group["items"]]
        nodes, labels, probes, stored = (group[c].tolist() for c in ("node", "label", "probe", "stored"))
        return pd.DataFrame(block_links(nodes, sets, labels, probes, stored, percent), columns=["a", "b"], dtype="int64")

    return link


# -- the join -----------------------------------------------------------------------------------


def small_side(table: DataFrame, row_bytes: int) -> DataFrame:
    """Marked for broadcast when its counted rows are below a fixed number of bytes, else left to a shuffle."""
    return F.broadcast(table) if table.count() * row_bytes <= BROADCAST_BYTES else table


def similar_components(docs: DataFrame, width: int = 4, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the key, ``n_shingles, class_id, component_id, group_id, text_hash``.

    Two documents link when ``100 * intersection >= percent * union`` of their shingle sets.
    ``class_id`` is the smallest key with the same set, ``component_id`` the smallest key reachable by
    links, ``group_id`` a number of the component that no other has (null for a document that is linked
    with nothing by rule), ``text_hash`` the xxhash64 of the text, which with the key names a row. Null and empty texts have no shingles and are linked with nothing. Rows without a key take
    part in nothing and get null ids. Repeated rows are in one class; rows that share a key but not the
    text are linked each by its own text. No rows in, no rows out. A set is known by a 64-bit signature
    and its size, a shingle by 58 bits of its hash.
    """
    if not 1 <= percent <= 100 or width < 1:
        raise ValueError("percent must be in 1..100 and width positive")
    texts = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    classes = docs.sparkSession.sparkContext.broadcast(frequency_classes(texts.select("text"), width))
    schema = "key bigint, text_hash bigint, n_shingles bigint, node bigint, prefix array<bigint>"
    described = stage(texts.mapInPandas(_described(width, percent, classes), schema), "shingles")
    named = described.filter("key is not null and n_shingles > 0")
    reps = stage(named.groupBy("node", "n_shingles").agg(F.min("key").alias("rep")), "classes")

    labels = _links(texts, named, reps, classes, width, percent)
    rooted = reps.select("node", "n_shingles", "rep").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    wanted = rooted.join(least, "root").select(
        "node", "n_shingles", F.col("rep").alias("class_id"), "component_id", F.col("root").alias("group_id")
    )

    def shown(name: str) -> Column:
        own = F.when(F.col("n_shingles") == 0, F.col("key")).otherwise(F.col(name))
        return F.when(F.col("key").isNotNull(), own).alias(name)

    group = F.when(F.col("key").isNotNull() & (F.col("n_shingles") > 0), F.col("group_id")).alias("group_id")
    joined = described.drop("prefix").join(wanted, ["node", "n_shingles"], "left")
    return joined.select(F.col("key").alias(key), "n_shingles", shown("class_id"), shown("component_id"), group, "text_hash")


def _cells(named: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """``hub, node, anchor, blocks``: classes that may be similar to another one of the cell."""
    tokens = named.select("node", F.explode("prefix").alias("token"))
    order = Window.partitionBy("token").orderBy("node")
    marked = tokens.select(
        "node",
        F.first("node").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("hub"),
        F.lead("node").over(order).alias("next"),
    )
    met = marked.filter("node <> hub or next <> hub")
    pairs = stage(met.groupBy("hub", "node").agg(F.count("*").alias("shared")), "pairs")
    # Of the shingles that two similar sets share, each may lose up to half by leaving its least cells:
    # at least one is left in a cell that both stay in.
    rising = Window.partitionBy("node").orderBy("shared", "hub").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    least = _least_shared(F.col("n_shingles"), percent)
    weighed = pairs.join(reps.select("node", "n_shingles"), "node").withColumns(
        {"lost": F.sum("shared").over(rising), "all": F.sum("shared").over(Window.partitionBy("node"))}
    )
    stays = (F.col("all") >= least) & (F.col("lost") > F.floor((least - 1) / 2))
    cells = stage(weighed.filter(stays).select("hub", "node", "n_shingles"), "cells")
    sizes = cells.groupBy("hub").agg(
        F.count("*").alias("n"), F.min("node").alias("anchor"), F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most")
    )
    apart = (F.col("n") == 2) & (F.col("least") * 100 < F.col("most") * percent)
    kept = sizes.filter((F.col("n") >= 2) & ~apart).select("hub", "anchor", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    return cells.select("hub", "node").distinct().join(kept, "hub")


def _links(texts: DataFrame, named: DataFrame, reps: DataFrame, classes, width: int, percent: int) -> DataFrame:
    """``node, root`` of the classes that are linked with another one."""
    one = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    all_blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    where = F.when(F.col("anchor") == F.col("node"), all_blocks).otherwise(F.array(one))
    cells = _cells(named, reps, percent)
    members = stage(cells.select("hub", "node", "anchor", "blocks", F.explode(where).alias("block")), "members")

    met = members.select("node").distinct().join(reps.select("node", "rep"), "node").select(F.col("rep").alias("key")).distinct()
    chosen = texts.join(small_side(stage(met, "met"), 32), "key", "left_semi").select("text")
    items = chosen.mapInPandas(_set_bytes(width, classes), "node bigint, items binary").dropDuplicates(["node"])

    shape, link = "a bigint, b bigint", _linked(percent)
    role = {"asks": [F.lit(True).alias("probe"), F.lit(False).alias("stored")], "told": [F.lit(False).alias("probe"), F.lit(True).alias("stored")]}
    both = [F.lit(True).alias("probe"), F.lit(True).alias("stored")]
    blocks = members.join(items, "node").select("hub", "block", "node", "items", F.col("node").alias("label"), *both)
    links = stage(blocks.groupBy("hub", "block").applyInPandas(link, shape), "links")
    labels = connected_components(links)

    # Cells of several blocks: what is not connected with the smallest class meets all other blocks.
    wide = members.filter("blocks > 1").join(labels, "node", "left")
    wide = stage(wide.select("hub", "block", "blocks", "node", "anchor", F.coalesce("root", "node").alias("label")), "wide-cells")
    first = wide.filter("anchor = node").select("hub", F.col("label").alias("main")).distinct()
    rest = stage(wide.join(first, "hub").filter("label <> main").drop("main"), "unconnected")
    if rest.isEmpty():
        return labels
    counts = rest.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("rows"))
    row = F.pmod(F.xxhash64("node", F.lit(1)), F.col("rows")).cast("int").alias("row")
    every_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    every_row = F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row")
    asking = rest.join(counts, "hub").select("hub", row, every_block, "node", "label", *role["asks"])
    asked = wide.join(counts, "hub").select("hub", every_row, "block", "node", "label", *role["told"])
    tiles = asking.union(asked).join(items, "node")
    more = stage(tiles.groupBy("hub", "row", "block").applyInPandas(link, shape), "more-links")
    return connected_components(links.union(more))
