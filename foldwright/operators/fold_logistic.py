"""Logistic regressions of all training parts at once, and boosting with them.

The rows of a training part are all folds but one, so the parts share almost all of their rows. A pass
over the folded table gives every part what its next Newton step needs (loss, gradient and the weighted
Gram matrix of its slots) as sums over rows: each task adds up its rows for all parts, the shuffle adds up
the tasks, and k small matrices reach the driver. So ten folds cost as many passes as one, and a boosting
round is a few passes for all folds instead of a fit for each.

The steps are solved in each part's own standardized slots, as the penalty is defined there. Slots that
depend on each other, such as all categories of a column, share a coefficient evenly: the solution is the
shortest one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.functions.scores import exp_sigmoid, threshold_predict
from foldwright.operators.boosting import boost_alpha, weight_total
from foldwright.staging import stage

#: A part's Gram matrix has the square of this many numbers at most; wider vectors need a solver without it.
GRAM_SLOTS = 512
#: A step this short is the last: Newton steps square the error.
_SHORT = 1e-6
_SWEEPS = 1000


@dataclass(frozen=True)
class Linear:
    """``intercept + coefficients . x``; class 1 where that is positive."""

    intercept: float
    coefficients: tuple[float, ...]


@dataclass(frozen=True)
class LinearRound:
    learner: Linear
    err: float
    alpha: float


@dataclass
class _Part:
    """Where the fit of one training part stands. Coefficients are in shifted slots, the intercept first."""

    beta: np.ndarray
    trial: np.ndarray
    value: float = math.inf
    steps: int = 0
    done: bool = False
    weighing: bool = False
    rounds: list[tuple[np.ndarray, float, float]] = field(default_factory=list)
    scales: list[float] = field(default_factory=list)


@dataclass
class _Sums:
    """Over the rows of a part: weight, weight of class 1, loss, gradient, Gram matrix."""

    weight: float
    positive: float
    loss: float
    gradient: np.ndarray
    gram: np.ndarray

    @classmethod
    def of(cls, cells: np.ndarray, width: int) -> _Sums:
        return cls(cells[0], cells[1], cells[2], cells[3 : 3 + width], cells[3 + width :].reshape(width, width))

    def times(self, factor: float) -> _Sums:
        return _Sums(*(factor * x for x in (self.weight, self.positive, self.loss, self.gradient, self.gram)))

    def plus(self, other: _Sums) -> _Sums:
        return _Sums(
            self.weight + other.weight,
            self.positive + other.positive,
            self.loss + other.loss,
            self.gradient + other.gradient,
            self.gram + other.gram,
        )


def _cells(z: np.ndarray, y: np.ndarray, w: np.ndarray, margin: np.ndarray) -> np.ndarray:
    p = 1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700)))
    loss = np.logaddexp(0.0, margin) - y * margin
    gram = (z * (w * p * (1.0 - p))[:, None]).T @ z
    return np.concatenate([[w.sum(), w @ y, w @ loss], z.T @ (w * (p - y)), gram.ravel()])


def _summed(parts: dict[int, _Part], center: np.ndarray, scale: np.ndarray) -> Callable:
    """For each part (two rows of cells while rounds are weighed: rows its learner misses, and the others)."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            fold, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            z = np.hstack([np.ones((len(batch), 1)), (x - center) / scale])
            for i, part in parts.items():
                w = (fold != i).astype(np.float64)
                for (learner, alpha, _), grown in zip(part.rounds, part.scales, strict=True):
                    missed = (z @ learner > 0) != (y > 0.5)
                    w *= np.exp(np.where(missed, alpha, -alpha)) / grown
                if part.weighing:
                    missed = ((z @ part.beta > 0) != (y > 0.5)).astype(np.float64)
                    flat = np.zeros(len(y))
                    found = {0: _cells(z, y, w * missed, flat), 1: _cells(z, y, w * (1.0 - missed), flat)}
                else:
                    found = {0: _cells(z, y, w, z @ part.trial)}
                for side, cells in found.items():
                    total[i, side] = total[i, side] + cells if (i, side) in total else cells
        for (i, side), cells in total.items():
            n = len(cells)
            columns = [np.full(n, i, np.int32), np.full(n, side, np.int32), np.arange(n, dtype=np.int32), cells]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "side", "cell", "value"])

    return add_up


class _Table:
    """The folded rows, shifted so that all slots are of one size, read once in each pass."""

    def __init__(self, folded: DataFrame, label: str, features: str) -> None:
        rows = folded.select(F.col("fold").cast("int").alias("fold"), F.col(label).cast("double").alias("label"), features)
        if rows.isEmpty():
            raise ValueError("a fit needs at least one row")
        moments = rows.agg(Summarizer.mean(F.col(features)).alias("mean"), Summarizer.std(F.col(features)).alias("std")).first()
        self.center, std = moments["mean"].toArray(), moments["std"].toArray()
        if len(self.center) > GRAM_SLOTS:
            raise ValueError(f"{len(self.center)} slots: shared passes take {GRAM_SLOTS} at most")
        self.scale = np.where(std > 0, std, 1.0)
        self.width = len(self.center) + 1
        self.rows = stage(rows.select("fold", "label", vector_to_array(features).alias("x")), "fold-rows")

    def sums(self, parts: dict[int, _Part]) -> dict[int, list[_Sums]]:
        """What one pass gives each part: k times the square of the slots, whatever the rows."""
        found = self.rows.mapInArrow(_summed(parts, self.center, self.scale), "part int, side int, cell int, value double")
        size = 3 + self.width + self.width**2
        cells = {(i, side): np.zeros(size) for i, p in parts.items() for side in range(1 + p.weighing)}
        for row in found.groupBy("part", "side", "cell").agg(F.sum("value").alias("value")).toLocalIterator():
            cells[row["part"], row["side"]][row["cell"]] = row["value"]
        return {i: [_Sums.of(cells[i, side], self.width) for side in range(1 + p.weighing)] for i, p in parts.items()}

    def linear(self, beta: np.ndarray) -> Linear:
        """The coefficients for the slots as they were given."""
        slope = beta[1:] / self.scale
        return Linear(float(beta[0] - slope @ self.center), tuple(slope.tolist()))


def _basis(gram: np.ndarray, weight: float, unit: float) -> np.ndarray:
    """The matrix from a part's standardized slots to the shifted ones. ``gram`` is a quarter of the plain one."""
    plain = 4.0 * gram
    mean = plain[0] / weight
    spread = np.maximum(np.diag(plain) - weight * mean**2, 0.0)
    # Of slots that are 0 or 1 the rounding of sums leaves a spread of this order.
    spread[spread < 1e-12 * np.maximum(np.diag(plain), 1e-300)] = 0.0
    std = np.sqrt(spread * unit)
    inverse = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
    basis = np.diag(inverse)
    basis[0] = -mean * inverse
    basis[0, 0] = 1.0
    return basis


def _penalty(theta: np.ndarray, reg: float, mix: float) -> float:
    return reg * ((1.0 - mix) / 2.0 * float(theta[1:] @ theta[1:]) + mix * float(np.abs(theta[1:]).sum()))


def _direction(theta: np.ndarray, gradient: np.ndarray, curve: np.ndarray, reg: float, mix: float) -> np.ndarray:
    """The step to the lowest point of the quadratic model plus the penalty."""
    if reg * mix == 0:
        ridge = np.full(len(theta), reg * (1.0 - mix))
        ridge[0] = 0.0
        return np.linalg.lstsq(curve + np.diag(ridge), -(gradient + ridge * theta), rcond=1e-12)[0]
    new = theta.copy()
    pull = gradient - curve @ theta  # of the smooth part, without the new point's own share
    for _ in range(_SWEEPS):
        moved = 0.0
        for j in range(len(theta)):
            rest = pull[j] + curve[j] @ new - curve[j, j] * new[j]
            if j == 0:
                value = -rest / curve[0, 0]
            elif curve[j, j] == 0:
                value = 0.0
            else:
                value = math.copysign(max(abs(rest) - reg * mix, 0.0), -rest) / (curve[j, j] + reg * (1.0 - mix))
            moved, new[j] = max(moved, abs(value - new[j])), value
        if moved < 1e-13:
            break
    return new - theta


class _Solver:
    """Newton steps of one part, each from the sums of a pass at ``trial``."""

    def __init__(self, part: _Part, first: _Sums, reg: float, mix: float, max_iter: int) -> None:
        self.part, self.reg, self.mix, self.max_iter = part, reg, mix, max_iter
        n = first.weight
        # Sample variances for unit weights; weights that sum to one are a distribution.
        self.basis = _basis(first.gram, n, 1.0 / (n - 1.0) if n > 1.5 else 1.0 / n)
        self.theta = np.zeros(len(part.trial))
        self.next = self.theta
        part.value, part.steps, part.done = math.inf, 0, False
        if not 1e-12 * n < first.positive < (1.0 - 1e-12) * n:
            # One class only: it is certain.
            part.beta = np.zeros(len(part.trial))
            part.beta[0] = math.inf if first.positive > n / 2 else -math.inf
            part.done = True
        else:
            self.take(first)

    def take(self, sums: _Sums) -> None:
        part = self.part
        value = sums.loss / sums.weight + _penalty(self.next, self.reg, self.mix)
        if value > part.value + 1e-12 * abs(part.value):
            step = (self.next - self.theta) / 2.0
        else:
            self.theta, part.value = self.next, value
            gradient = self.basis.T @ sums.gradient / sums.weight
            curve = self.basis.T @ sums.gram @ self.basis / sums.weight
            step = _direction(self.theta, gradient, curve, self.reg, self.mix)
        part.steps += 1
        self.next = self.theta + step
        part.trial = self.basis @ self.next
        if np.abs(step).max() < _SHORT or part.steps >= self.max_iter:
            part.beta, part.done = part.trial, True


def _start(table: _Table, k: int) -> dict[int, _Part]:
    return {i: _Part(np.zeros(table.width), np.zeros(table.width)) for i in range(k)}


def _checked(sums: _Sums, i: int) -> _Sums:
    if sums.weight <= 0:
        raise ValueError(f"the training part of fold {i} has no rows")
    return sums


def fold_logistic(
    folded: DataFrame,
    k: int,
    reg: float = 0.01,
    mix: float = 0.5,
    max_iter: int = 100,
    label: str = "label",
    features: str = "features",
) -> list[Linear]:
    """The elastic-net logistic regression of each training part (all folds but fold i), in shared passes.

    The penalty is on coefficients of standardized slots, as MLlib's is. Vectors have at most
    ``GRAM_SLOTS`` slots. A part with one class has an infinite intercept; a part without rows raises.
    """
    table = _Table(folded, label, features)
    parts = _start(table, k)
    solvers = {i: _Solver(parts[i], _checked(s[0], i), reg, mix, max_iter) for i, s in table.sums(parts).items()}
    while open_ := {i: p for i, p in parts.items() if not p.done}:
        for i, sums in table.sums(open_).items():
            solvers[i].take(sums[0])
    return [table.linear(parts[i].beta) for i in range(k)]


def fold_adaboost(
    folded: DataFrame,
    k: int,
    rounds: int = 10,
    early_stop: bool = False,
    max_iter: int = 50,
    label: str = "label",
    features: str = "features",
) -> list[list[LinearRound]]:
    """Boosted unregularized logistic regressions of each training part, in shared passes.

    The pass that measures a round's error also sums up missed and other rows apart; the new weights
    multiply these two sums, so it is the first step of the next round as well. ``early_stop`` ends a
    part's rounds before a learner that is no better than chance.
    """
    table = _Table(folded, label, features)
    parts = _start(table, k)
    ended: set[int] = set()
    solvers: dict[int, _Solver] = {}
    for i, sums in table.sums(parts).items():
        whole = _checked(sums[0], i)
        parts[i].scales, parts[i].rounds = [], []
        # Weights sum to one from the start.
        parts[i].rounds.append((np.zeros(table.width), 0.0, 0.0))
        parts[i].scales.append(whole.weight)
        solvers[i] = _Solver(parts[i], whole.times(1.0 / whole.weight), 0.0, 0.0, max_iter)
    while open_ := {i: p for i, p in parts.items() if i not in ended}:
        for p in open_.values():
            p.weighing = p.done
        for i, sums in table.sums(open_).items():
            part = parts[i]
            if not part.weighing:
                solvers[i].take(sums[0])
                continue
            missed, hit = sums
            err, total = float(missed.weight), float(missed.weight + hit.weight)
            if early_stop and err >= 0.5:
                ended.add(i)
                continue
            alpha = boost_alpha(err)
            grown = weight_total(alpha, err, total)
            part.rounds.append((part.beta, alpha, err))
            part.scales.append(grown)
            if len(part.rounds) > rounds:
                ended.add(i)
                continue
            first = missed.times(math.exp(alpha) / grown).plus(hit.times(math.exp(-alpha) / grown))
            solvers[i] = _Solver(part, first, 0.0, 0.0, max_iter)
    return [[LinearRound(table.linear(b), err, alpha) for b, alpha, err in parts[i].rounds[1:]] for i in range(k)]


def _model_table(df: DataFrame, models: Sequence[Sequence[tuple[Linear, float]]]) -> DataFrame:
    """``(_fold, _learners)``: one row for each fold, with (intercept, coefficients, alpha) of its learners.

    It is marked for broadcast: Spark takes rows from the driver for a table of any size, and would send out the
    scored table instead wherever its files are small.
    """
    rows = [(i, [(m.intercept, list(m.coefficients), float(a)) for m, a in learners]) for i, learners in enumerate(models)]
    schema = "_fold int, _learners array<struct<intercept: double, coefficients: array<double>, alpha: double>>"
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def _raw(learner: Column, x: Column) -> Column:
    products = F.zip_with(learner["coefficients"], x, lambda a, b: a * b)
    return learner["intercept"] + F.aggregate(products, F.lit(0.0), lambda held, v: held + v)


def logistic_predictions(
    folded: DataFrame, models: Sequence[Linear], keep: Sequence[str] = (), label: str = "label", features: str = "features"
) -> DataFrame:
    """``(fold, keep..., label, prediction, p1, score)``: every row scored by the model that did not see its fold, in one scan."""
    joined = folded.join(_model_table(folded, [[(m, 1.0)] for m in models]), F.col("fold") == F.col("_fold"))
    scored = joined.withColumn("score", _raw(F.get("_learners", F.lit(0)), vector_to_array(F.col(features))))
    p1 = exp_sigmoid(F.col("score"))
    return scored.select("fold", *keep, F.col(label).cast("double").alias("label"), (p1 > 0.5).cast("double").alias("prediction"), p1.alias("p1"), "score")


def adaboost_predictions(
    folded: DataFrame,
    models: Sequence[Sequence[LinearRound]],
    keep: Sequence[str] = (),
    label: str = "label",
    features: str = "features",
) -> DataFrame:
    """``(fold, keep..., label, prediction, p1, score)`` by the weighted vote of the fold's learners, in one scan."""
    joined = folded.join(_model_table(folded, [[(r.learner, r.alpha) for r in rounds] for rounds in models]), F.col("fold") == F.col("_fold"))
    x = vector_to_array(F.col(features))
    votes = F.transform("_learners", lambda m: F.when(_raw(m, x) > 0, m["alpha"]).otherwise(-m["alpha"]))
    scored = joined.withColumn("p1", exp_sigmoid(F.aggregate(votes, F.lit(0.0), lambda held, v: held + v)))
    prediction = threshold_predict(F.col("p1")).alias("prediction")
    return scored.select("fold", *keep, F.col(label).cast("double").alias("label"), prediction, "p1", F.col("p1").alias("score"))
