"""How far the sources of a language stand apart: exact term counts, group sums, sparse pair evaluation.

1. Every text becomes an exact sparse vector of term counts, and the vectors of a (language, source)
   group are added up as a summarizer does: for each term the sum and the number of non-zero entries.
   Tasks add up what they read, the shuffle merges by (language, source, term), so neither a frequent
   term nor a large source meets in one task before it is summed.
2. The vocabulary of a language holds the terms that are non-zero in at least ``min_df`` of its
   vectors, as a count vectorizer's does whose size is the largest integer: no term is cut. It stays a
   distributed table, since it grows with the corpus, where the library's vectorizer keeps it on the driver.
3. A term has the smoothed share p in a group, in billionths, floored. The distance of two groups is the
   sum of f(p, q) = floor((p - q)^2 / q) over the vocabulary. A term that a group lacks has the same
   share as every other one it lacks, so the sum splits into what each group's own counts give against
   a lacking partner, taken once for each distinct share, and a correction for the terms that both
   have. Only those are met term by term, in blocks of the vocabulary.

All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwright.llm.trie_join import small_side
from foldwright.staging import stage

SCALE = 1_000_000_000
#: Terms that a task sums before it hands them on.
BUFFER_TERMS = 1_000_000
#: Entries (term, group) of a block, about.
BLOCK_ENTRIES = 40_000
#: A task sees fewer words than this number of bits can count.
_BITS = 48
_ONE = 1 << _BITS
#: Pairs of entries that are looked at together in a block.
_PAIRS = 1 << 20
#: Parts of a group that are ranked before the whole group.
_SALTS = 32
#: Bytes of a row of the table of groups, about.
_GROUP_BYTES = 96
#: Letters: everything outside ASCII, and A-Z lower-cased with a-z; all other bytes part the terms.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def term_vector(text: bytes | None) -> Counter[bytes]:
    """The exact counts of the terms of one text: runs of letters and of signs outside ASCII."""
    return Counter((text or b"").translate(_LETTERS).split())


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # The sum of a term, and above its bits the number of vectors that have it.
    sums: dict[tuple, dict[bytes, int]] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for group, counts in sums.items():
            if not counts:
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(pa.scalar(group[0], pa.string()), len(counts)),
                    pa.repeat(pa.scalar(group[1], pa.string()), len(counts)),
                    pa.array(counts.keys(), pa.binary()),
                    pa.array([v & (_ONE - 1) for v in counts.values()], pa.int64()),
                    pa.array([v >> _BITS for v in counts.values()], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        sums.clear()

    held = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2), strict=True):
            total = sums.setdefault((lang, source), {})
            before, known = len(total), total.get
            for term, n in term_vector(text.as_py()).items():
                total[term] = known(term, 0) + n + _ONE
            held += len(total) - before
            if held >= BUFFER_TERMS:
                yield from flushed()
                held = 0
    yield from flushed()


def _group(lang: str, source: str) -> list[Column]:
    """Null languages and sources count as empty ones."""
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"))]


def group_sums(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)``: sum and number of non-zero entries of the group's vectors; terms are UTF-8.

    Null texts, languages and sources count as empty ones.
    """
    rows = docs.select(*_group(lang, source), F.col(text).cast("binary").alias("text"))
    parts = rows.mapInArrow(_summed, "lang string, source string, term binary, n bigint, docs bigint")
    # The tasks have added up already. Dealt by term, the sums serve the vocabulary without another shuffle.
    dealt = parts.repartition("lang", "term")
    return dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def vocabulary(sums: DataFrame, min_df: int) -> DataFrame:
    """``(lang, term, n, groups)``: the kept terms with their counts, in all and by source."""
    groups = F.collect_list(F.struct("source", "n")).alias("groups")
    kept = sums.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), groups)
    return kept.filter(F.col("docs") >= min_df).select("lang", F.col("term").cast("string").alias("term"), "n", "groups")


def _share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + size)), in decimals where a product may leave 64 bits."""
    exact = (n.cast("decimal(19,0)") + F.lit(1)) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", exact, (total + size).cast("decimal(20,0)")) + F.lit(1).cast("bigint")


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) of whole numbers below 2^31."""
    return F.call_function("div", (p - q) * (p - q), q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def pair_corrections(term: np.ndarray, group: np.ndarray, share: np.ndarray, lacking: np.ndarray) -> dict[tuple[int, int], int]:
    """Over all terms and ordered pairs of groups that both have one: f as it is, less f as if one, then the other lacked it, plus f of two that lack it.

    ``term`` is sorted. ``lacking`` is the share of a term that the entry's group lacks.
    """
    starts = np.flatnonzero(np.diff(term, prepend=term[:1] - 1))
    sizes = np.diff(np.append(starts, len(term)))
    total: dict[tuple[int, int], int] = {}
    # Terms are taken together as long as their pairs fit; a term with more groups is cut by its left partners.
    ends = np.cumsum(sizes**2)
    at = 0
    while at < len(starts):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, side="right")))
        first, last = starts[at], starts[upto - 1] + sizes[upto - 1]
        width = np.repeat(sizes[at:upto], sizes[at:upto])
        head = np.repeat(starts[at:upto], sizes[at:upto])
        step = max(1, _PAIRS // int(width.max()))
        for low in range(0, last - first, step):
            wide, base = width[low : low + step], head[low : low + step]
            a = np.repeat(np.arange(first + low, first + low + len(wide)), wide)
            b = np.arange(len(a)) - np.repeat(np.cumsum(wide) - wide, wide) + np.repeat(base, wide)
            p, q, zero_p, zero_q = share[a], share[b], lacking[a], lacking[b]
            gain = _f(p, q) - _f(p, zero_q) - _f(zero_p, q) + _f(zero_p, zero_q)
            pair = group[a] * np.int64(1 << 31) + group[b]
            order = np.argsort(pair, kind="stable")
            heads = np.flatnonzero(np.diff(pair[order], prepend=-1))
            for key, value in zip(pair[order][heads].tolist(), np.add.reduceat(gain[order], heads).tolist(), strict=True):
                name = divmod(key, 1 << 31)
                if name[0] != name[1]:
                    total[name] = total.get(name, 0) + value
        at = upto
    return total


def _block(group: pd.DataFrame) -> pd.DataFrame:
    term = pd.factorize(group["term"])[0].astype(np.int64)
    order = np.argsort(term, kind="stable")
    code, names = pd.factorize(group["source"])
    share, lacking = group["p"].to_numpy(np.int64), group["lacking"].to_numpy(np.int64)
    found = pair_corrections(term[order], code.astype(np.int64)[order], share[order], lacking[order])
    pairs = list(found)
    return pd.DataFrame(
        {
            "lang": np.array([group["lang"].iloc[0]] * len(pairs), dtype=object),
            "source": np.array([names[a] for a, _ in pairs], dtype=object),
            "item": np.array([names[b] for _, b in pairs], dtype=object),
            "value": np.array(list(found.values()), dtype=np.int64),
        }
    )


def _pairs(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for all ordered pairs of sources of a language."""
    size = entries.count()
    block = F.pmod(F.xxhash64("term"), F.lit(-(-size // BLOCK_ENTRIES) or 1)).cast("int").alias("block")
    shared = entries.select("lang", "term", "source", "p", "lacking", block).groupBy("lang", "block")
    corrections = shared.applyInPandas(_block, "lang string, source string, item string, value bigint")

    # A group against a partner that lacks the term: once for each distinct share of the group.
    shares = entries.groupBy("lang", "source", "p").agg(F.count("*").alias("terms"))
    partner = groups.select("lang", F.col("source").alias("item"), F.col("lacking").alias("other"), "terms", "size")
    side = small_side(partner.select("lang", "item", "other"), _GROUP_BYTES)
    met = shares.join(side, "lang").filter("source <> item")
    forth = met.select("lang", "source", "item", (F.col("terms") * _apart(F.col("p"), F.col("other"))).alias("value"))
    back = met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (F.col("terms") * _apart(F.col("other"), F.col("p"))).alias("value"))
    neither = (
        groups.select("lang", "source", F.col("lacking").alias("own"), F.col("terms").alias("own_terms"))
        .join(small_side(partner, _GROUP_BYTES), "lang")
        .filter("source <> item")
        .select("lang", "source", "item", ((F.col("size") - F.col("own_terms") - F.col("terms")) * _apart(F.col("own"), F.col("other"))).alias("value"))
    )
    # A pair's many parts meet in two steps, as one language may hold most of them.
    parts = neither.unionByName(forth).unionByName(back).unionByName(corrections)
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _best_terms(entries: DataFrame, most: int) -> DataFrame:
    """The terms of each group that stand out most; parts of a group are ranked before the whole."""
    apart = entries.filter("p > q").select("lang", "source", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    order = [F.desc("value"), F.asc("item")]
    part = Window.partitionBy("lang", "source", "salt").orderBy(*order)
    salted = apart.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(_SALTS)))
    few = salted.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= most).drop("rank", "salt")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))).filter(F.col("rank") <= most)


def source_divergence(
    docs: DataFrame, min_df: int = 3, most_terms: int = 200, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for each occurring group of language and source.

    Part ``pair`` has the distance to every other source of the language, all ranks; part ``term`` the
    ``most_terms`` terms of the group whose share exceeds the language's, by their part of the distance.
    Ranks run by value descending, then by the item's UTF-8 bytes. Null texts, languages and sources
    count as empty. Groups without a term take part with equal shares; where a language keeps no term,
    all values are 0. Repeated rows count as often as they stand. No rows in, no rows out; other
    columns are not read.
    """
    if min_df < 1 or most_terms < 0:
        raise ValueError("min_df must be positive, most_terms not negative")
    terms = stage(vocabulary(group_sums(docs, text, lang, source), min_df), "vocabulary")
    flat = terms.select("lang", "term", F.col("n").alias("lang_n"), F.inline("groups"))

    sizes = terms.groupBy("lang").agg(F.count("*").alias("size"), F.sum("n").alias("lang_total"))
    totals = flat.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    occurring = docs.select(*_group(lang, source)).distinct()
    groups = occurring.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = groups.na.fill(0, ["total", "terms", "size", "lang_total"])
    # Without a kept term no share is used; 1 stands for it.
    lacking = F.when(F.col("size") > 0, _share(F.lit(0), F.col("total"), F.greatest("size", F.lit(1)))).otherwise(F.lit(1).cast("bigint"))
    groups = stage(groups.withColumn("lacking", lacking), "groups")

    known = small_side(groups.withColumnRenamed("terms", "own_terms"), _GROUP_BYTES)
    entries = flat.join(known, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        _share(F.col("n"), F.col("total"), F.col("size")).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("size")).alias("q"),
        "lacking",
    )
    entries = stage(entries, "entries")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = _pairs(entries, groups).withColumn("rank", F.row_number().over(by_value))
    parts = (pairs.withColumn("part", F.lit("pair")), _best_terms(entries, most_terms).withColumn("part", F.lit("term")))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return parts[0].select(columns).unionByName(parts[1].select(columns))
