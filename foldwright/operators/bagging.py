"""Bagging: bootstraps, the trees fitted on them, and the majority vote."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwright.functions.keys import poisson_weight
from foldwright.functions.scores import positive_share, threshold_predict, to_prob_vec
from foldwright.operators.folds import in_parallel
from foldwright.operators.learners import only_prediction, tree_fit
from foldwright.staging import stage

_BITS = 62
#: MLlib takes the splits of this many rows from all of them, and of slots with at most so many values from each value.
_SMALL_TABLE = 10_000
_BINS = 32


def bootstrap_sample(
    df: DataFrame, key: str | Sequence[str], i: int, seed: int = 42, fraction: float = 1.0, out: str = "w"
) -> DataFrame:
    """Rows of bootstrap ``i``, each once with its number of copies in ``out``."""
    return df.withColumn(out, poisson_weight(key, i, seed, fraction)).filter(F.col(out) > 0)


def shared_bootstraps(
    train: DataFrame, key: str | Sequence[str], num_models: int, seed: int, fraction: float, label: str, features: str
) -> DataFrame | None:
    """Staged ``(label, features, w_0, w_1, ...)``: each distinct row with its copies in every bootstrap, from one pass.

    Trees see only sums of weights, so they grow alike on it. None where the distinct rows or a slot's values
    are too many for MLlib to split between all values: there its splits follow from a draw of the rows.
    """
    if train.agg(F.approx_count_distinct(F.xxhash64(label, features)).alias("n")).first()["n"] > _SMALL_TABLE:
        return None
    copies = [F.sum(poisson_weight(key, i, seed, fraction).cast("double")).alias(f"w_{i}") for i in range(num_models)]
    held = stage(train.groupBy(label, features).agg(*copies).coalesce(1), "bootstraps")
    if held.count() > _SMALL_TABLE:
        return None
    values = held.filter(F.col(features).isNotNull()).select(F.posexplode(vector_to_array(features)).alias("slot", "value"))
    most = values.groupBy("slot").agg(F.count_distinct("value").alias("n")).agg(F.max("n").alias("n")).first()["n"]
    return held if most is not None and most <= _BINS else None


def bagging_fit(
    train: DataFrame,
    num_models: int = 25,
    sample_fraction: float = 1.0,
    max_depth: int = 5,
    seed: int = 42,
    label: str = "label",
    features: str = "features",
    strategy: str = "forest",
    key: str | Sequence[str] | None = None,
    parallelism: int = 4,
) -> list[DecisionTreeClassificationModel]:
    """``num_models`` trees, each fitted on its own bootstrap over all features.

    ``forest`` grows them together, so a pass over the data serves one level of all
    trees. ``separate`` fits them one by one on ``bootstrap_sample`` weights of ``key``;
    where the distinct rows are few, one pass over ``train`` serves all of them.
    """
    if strategy == "forest":
        forest = RandomForestClassifier(
            labelCol=label,
            featuresCol=features,
            numTrees=num_models,
            featureSubsetStrategy="all",
            subsamplingRate=sample_fraction,
            bootstrap=True,
            maxDepth=max_depth,
            seed=seed,
        )
        return list(forest.fit(train).trees)
    if strategy == "separate":
        if key is None:
            raise ValueError("separate fits need a key for their bootstraps")

        held = shared_bootstraps(train, key, num_models, seed, sample_fraction, label, features)

        def fit(i: int) -> DecisionTreeClassificationModel:
            if held is not None:
                return tree_fit(held.filter(F.col(f"w_{i}") > 0), label, features, max_depth, seed + i, weight=f"w_{i}")
            rows = bootstrap_sample(train, key, i, seed, sample_fraction)
            return tree_fit(rows, label, features, max_depth, seed + i, weight="w")

        return in_parallel(train.sparkSession, fit, range(num_models), parallelism)
    raise ValueError(f"unknown strategy {strategy!r}")


def cast_votes(df: DataFrame, models: Sequence, prefix: str = "vote_") -> tuple[DataFrame, list[str]]:
    """Add each model's predicted class as a column: all models score a row in one projection, without a join."""
    names = [f"{prefix}{i}" for i in range(len(models))]
    for model, name in zip(models, names):
        df = only_prediction(model, name).transform(df)
    return df, names


def majority_vote(df: DataFrame, votes: Sequence[str], vector: bool = False) -> DataFrame:
    """Add ``p1`` (share of 0/1 votes for 1) and ``prediction``; a tie is positive.

    ``vector=True`` adds ``probability`` as an MLlib vector too.
    """
    scored = df.withColumn("p1", positive_share([F.col(v) for v in votes]))
    scored = scored.withColumn("prediction", threshold_predict(F.col("p1")))
    return scored.withColumn("probability", to_prob_vec(F.col("p1"))) if vector else scored


def vote_join(frames: Sequence[DataFrame], key: Sequence[str], vote: str = "vote") -> DataFrame:
    """``(key, votes, p1)`` from one ``(key, vote)`` table per model, for votes that were made apart.

    As with a chain of inner joins, only keys that every table has are kept, and null
    keys meet nothing, but one shuffle serves all tables. A key that a table repeats
    has no vote of its own there and is left out.
    """
    votes = [f.select(*key, F.col(vote).alias("_part")) for f in frames]
    n = F.lit(float(len(frames)))
    return sum_of_all(votes, key, "votes").select(*key, "votes", (F.col("votes") / n).alias("p1"))


def sum_of_all(frames: Sequence[DataFrame], key: Sequence[str], out: str) -> DataFrame:
    """``(key, out)``: sum of ``_part`` over the tables, for complete keys that each table has exactly once.

    Every table sets its own bit; as many rows as bits then mean one row from each.
    """
    full = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    tagged = [f.filter(full).withColumn("_table", F.lit(i)) for i, f in enumerate(frames)]
    bits = [F.col("_table") % _BITS == F.lit(i) for i in range(min(_BITS, len(frames)))]
    bit = reduce(lambda rest, i: F.when(bits[i], F.lit(1 << i)).otherwise(rest), range(len(bits)), F.lit(0).cast("bigint"))
    words = range(-(-len(frames) // _BITS))
    seen = [F.bit_or(F.when(F.floor(F.col("_table") / _BITS) == w, bit).otherwise(F.lit(0))).alias(f"_seen_{w}") for w in words]
    sums = reduce(DataFrame.unionByName, tagged).groupBy(*key).agg(F.sum("_part").alias(out), F.count("*").alias("_rows"), *seen)
    whole = F.col("_rows") == len(frames)
    for w in words:
        whole = whole & (F.col(f"_seen_{w}") == (1 << min(_BITS, len(frames) - w * _BITS)) - 1)
    return sums.filter(whole).select(*key, out)


def label_join(preds: DataFrame, labelled: DataFrame, key: Sequence[str]) -> DataFrame:
    """Bring the labels to predictions that were made apart: an inner join on the key."""
    return labelled.join(preds, list(key), "inner")


def bagging_predictor(num_models: int = 25, label: str = "label", **settings):
    """A ``fit_predict`` of the whole ensemble."""

    def fit_predict(train: DataFrame, test: DataFrame) -> DataFrame:
        trees = bagging_fit(train, num_models=num_models, label=label, **settings)
        voted, votes = cast_votes(test, trees)
        scored = majority_vote(voted, votes).drop(*votes)
        return scored.withColumns({"label": F.col(label).cast("double"), "score": F.col("p1")})

    return fit_predict
