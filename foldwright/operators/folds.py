"""Fold assignment and the cross-validation loop."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwright.functions.keys import hash_fold
from foldwright.operators.fold_prep import FoldPrep
from foldwright.operators.prep import PrepPipeline
from foldwright.staging import stage

FitPredict = Callable[[DataFrame, DataFrame], DataFrame]
Item = TypeVar("Item")
Result = TypeVar("Result")

SCORED = ["label", "prediction", "p1", "score"]


def in_parallel(
    spark: SparkSession, work: Callable[[Item], Result], items: Iterable[Item], parallelism: int
) -> list[Result]:
    """Run driver-side fits side by side, at most ``parallelism`` at once, results in order."""
    if parallelism <= 1:
        return [work(item) for item in items]
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def fold_assign(df: DataFrame, k: int, key: str | Sequence[str] = (), mode: str = "hash") -> DataFrame:
    """Add ``fold`` in 0..k-1.

    ``hash`` takes it from the key, so it is the same under any partitioning; rows
    with equal keys share a fold. ``row_id`` deals the rows out by their position in
    the partitions, which is even but changes when the partitions do; stage its
    result before using it twice.
    """
    if k < 2:
        raise ValueError("k must be at least 2")
    if mode == "hash":
        if not key:
            raise ValueError("hash folds need a key")
        return df.withColumn("fold", hash_fold(key, k))
    if mode == "row_id":
        return df.withColumn("fold", (F.monotonically_increasing_id() % k).cast("int"))
    raise ValueError(f"unknown mode {mode!r}")


def fold_split(df: DataFrame, i: int) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: every other fold, and fold ``i``."""
    return df.filter(F.col("fold") != i), df.filter(F.col("fold") == i)


def stage_folds(df: DataFrame) -> DataFrame:
    """Stage a table that has ``fold``, in a folder for each fold, so that a fold's scan reads only its own files."""
    return stage(df, "folds", by="fold")


def cross_validate(
    df: DataFrame,
    fit_predict: FitPredict,
    k: int,
    keep: Sequence[str] = (),
    prepare: Estimator | FoldPrep | None = None,
    fit_scope: str = "all",
    parallelism: int = 1,
    staged: bool = False,
) -> DataFrame:
    """``(fold, keep..., label, prediction, p1, score)`` for every row, scored by the model that did not see it.

    ``fit_predict(train, test)`` fits on ``train`` and returns ``test`` with the
    scored columns. ``prepare`` is fitted on all rows before the split, or with
    ``fit_scope='fold'`` on each training part, so that no test row takes part in it.
    A ``FoldPrep`` is fitted already, for every training part, and needs no fit here.
    With ``fit_scope='fold'`` and a fit that standardizes its training part by itself, the
    slots of ``prep_pipeline`` are made once and staged. A category that a training part
    lacks is a constant 0 there and has no coefficient, so no test row takes part either.
    The table is staged unless the caller did so (``staged=True``).

    The result unites one lazy branch per fold, each a scan of its own fold; stage
    it when several queries read it.
    """
    if fit_scope not in ("all", "fold"):
        raise ValueError(f"unknown fit_scope {fit_scope!r}")
    if isinstance(prepare, Estimator) and fit_scope == "all":
        df = prepare.fit(df).transform(df)
        staged = False
    table = df if staged else stage_folds(df)
    if fit_scope == "fold" and isinstance(prepare, PrepPipeline) and getattr(fit_predict, "standardizes", False):
        slots = prepare.unscaled().fit(table).transform(table).withColumn("features", F.col("features_unscaled"))
        table = stage_folds(slots.select(*dict.fromkeys([*keep, fit_predict.label, "fold", "features"])))
        prepare = None

    def run(i: int) -> DataFrame:
        train, test = fold_split(table, i)
        if isinstance(prepare, FoldPrep):
            train, test = prepare.transform(train, i), prepare.transform(test)
        elif prepare is not None and fit_scope == "fold":
            fitted = prepare.fit(train)
            train, test = fitted.transform(train), fitted.transform(test)
        return fit_predict(train, test).select(F.lit(i).alias("fold"), *keep, *SCORED)

    return reduce(DataFrame.unionByName, in_parallel(df.sparkSession, run, range(k), parallelism))
