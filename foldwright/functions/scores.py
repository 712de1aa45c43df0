"""Expressions that turn votes and margins into probabilities and predictions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column
from pyspark.sql import functions as F


def exp_sigmoid(score: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-score))


def threshold_predict(score: Column, cut: float = 0.5) -> Column:
    """1.0 at or above the cut, else 0.0: a tie counts as positive."""
    return (score >= F.lit(float(cut))).cast("double")


def to_prob_vec(p1: Column) -> Column:
    """``[1 - p1, p1]`` as an MLlib vector, built in the JVM."""
    return array_to_vector(F.array(1.0 - p1, p1))


def positive_share(votes: list[Column]) -> Column:
    """Share of 0/1 votes that are 1."""
    return reduce(add, votes) / F.lit(float(len(votes)))
