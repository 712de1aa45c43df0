"""Mix sources to target weights with hash thresholds. DataFrame operations only.

Every document has a fixed 60-bit hash. A source with a target of ``r`` times its size takes every
document ``floor(r)`` times, and once more those whose hash is below a threshold. The threshold is
found by histograms: words are summed by source and the top 12 bits, the bucket in which the budget
ends is refined by the next 12 bits, and so on; no document is ever sorted. A larger budget has a
higher threshold, so its selection contains the smaller one (nested budgets).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwright.llm.common import word_count
from foldwright.staging import stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BITS, LEVELS, HASH_BITS = 12, 3, 60


def document_hash(key: str, text: str) -> Column:
    """60 bits of an md5 of id and text: the same in every run and under any partitioning."""
    named = F.concat_ws("|", F.col(key).cast("string"), F.col(text))
    return F.conv(F.substring(F.md5(named), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: ``source, source_size, weight, target``.

    Sources are ordered by code point, null last, and weigh ``weights`` in turn. Together they get
    ``share`` of all words; a target stops at ``most`` times its source, and the excess goes to the
    others by weight. With the sources sorted by size per weight, those that stop come first, so the
    common level of the rest follows from two running sums.
    """
    if share > most:
        raise ValueError("the sources cannot give more than most times their size")
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    cap = F.col("source_size") * float(most)
    rising = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = rising.rowsBetween(Window.unboundedPreceding, -1)
    later = rising.rowsBetween(0, Window.unboundedFollowing)
    everything = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levelled = weighed.withColumn(
        "level",
        (F.sum("source_size").over(everything) * share - F.coalesce(F.sum(cap).over(earlier), F.lit(0.0)))
        / F.sum("weight").over(later),
    )
    free = F.when(F.col("level") * F.col("weight") <= cap, F.col("level"))
    level = F.first(free, ignorenulls=True).over(everything)
    bounded = F.when(F.coalesce(level * F.col("weight"), cap) < cap, level * F.col("weight")).otherwise(cap)
    return levelled.select("source", "source_size", "weight", bounded.alias("target"))


def thresholds(sized: DataFrame, needs: DataFrame) -> DataFrame:
    """The hash below which each source's ``need`` words lie: ``source, threshold``.

    ``sized`` has ``source, size, hash``; ``needs`` has ``source, need``, one row per source. Each
    level reads only the bucket in which the budget of a source ends. After the last level that
    bucket is a few documents (or rows that repeat one document); it is taken if that comes nearer.
    """
    ends = needs.select(F.col("source").alias("at"), "need", F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("before"))
    for level in range(1, LEVELS + 1):
        shift = HASH_BITS - BITS * level
        inside = F.col("source").eqNullSafe(F.col("at")) & (
            F.shiftright("hash", shift + BITS) == F.shiftright("start", shift + BITS)
        )
        sums = (
            sized.join(ends, inside)
            .groupBy("at", "need", "before", F.shiftright("hash", shift).alias("bucket"))
            .agg(F.sum("size").alias("words"))
        )
        upto = Window.partitionBy("at").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        running = sums.withColumn("before", F.col("before") + F.coalesce(F.sum("words").over(upto), F.lit(0)))
        # The last bucket that begins below the need.
        last = Window.partitionBy("at").orderBy(F.col("bucket").desc())
        crossing = running.filter((F.col("before") < F.col("need")) | (F.col("before") == 0)).withColumn("n", F.row_number().over(last))
        ends = stage(
            crossing.filter("n = 1").select(
                "at", "need", F.shiftleft("bucket", shift).alias("start"), F.col("before"), F.col("words")
            ),
            "boundary",
        )
    past = F.col("start") + F.lit(1 << (HASH_BITS - BITS * LEVELS))
    nearer = F.col("need") - F.col("before") > F.col("before") + F.col("words") - F.col("need")
    return ends.select("at", F.when(nearer, past).otherwise(F.col("start")).alias("threshold"))


def _sized(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    named = {"key": F.col(key), "source": F.col(source), "size": word_count(text), "hash": document_hash(key, text)}
    return stage(docs.select(*[column.alias(name) for name, column in named.items()]), "mix-sizes")


def mix_plan(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: ``at, source_size, target, whole, threshold``.

    A document of the source is taken ``whole`` times, and once more if its hash is below ``threshold``.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage(source_targets(sizes, weights, share, most), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = targets.withColumn("whole", F.floor(ratio)).withColumn(
        "need", F.col("target") - F.col("whole") * F.col("source_size")
    )
    cut = thresholds(sized, plan.filter("need > 0").select("source", "need"))
    joined = plan.join(cut, plan["source"].eqNullSafe(cut["at"]), "left").drop("at")
    return stage(
        joined.select(F.col("source").alias("at"), "source_size", "target", "whole", F.coalesce("threshold", F.lit(0)).alias("threshold")),
        "mix-plan",
    )


def _copies(hashed: Column) -> Column:
    return (F.col("whole") + (hashed < F.col("threshold")).cast("bigint")).cast("bigint")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """One row per document: the key, ``source, size, source_size, target, copies, taken``.

    ``taken`` is ``copies * size``. Null sources are one source, the last. Null and empty texts have
    size 0 and are taken as often as their hash says; a source without words has target 0 and no copies.
    Rows that repeat both id and text share a hash and are taken alike. No rows in, no rows out.
    """
    sized = _sized(docs, key, source, text)
    plan = mix_plan(sized, weights, share, most)
    return sized.join(plan, F.col("source").eqNullSafe(F.col("at"))).select(
        F.col("key").alias(key),
        F.col("source").alias(source),
        "size",
        "source_size",
        "target",
        _copies(F.col("hash")).alias("copies"),
        (_copies(F.col("hash")) * F.col("size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The rows themselves with all their columns, each as often as the mix takes it."""
    plan = mix_plan(_sized(docs, key, source, text), weights, share, most)
    named = {name: f"_mix_{name}" for name in plan.columns}
    own = plan.withColumnsRenamed(named)
    copies = F.col("_mix_whole") + (document_hash(key, text) < F.col("_mix_threshold")).cast("bigint")
    repeated = F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("_mix_copy")
    joined = docs.join(own, F.col(source).eqNullSafe(F.col("_mix_at")))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], repeated).drop("_mix_copy")
