"""Logistic regression of all categories in one optimiser.

The weights of C categories are one C x (d + 1) matrix. An evaluation is one job: every
task multiplies its rows with the whole matrix and returns the summed losses and gradients. Each
category has its own L-BFGS memory and step length, but all ask for their next value in
the same job, so the number of jobs is that of the slowest category, not the sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from presswork.learners.moments import score_rows
from presswork.learners.relevance import split
from presswork.operators.categories import indicator
from presswork.session import materialize, require_broadcastable

MEMORY = 10
GROUPS = 64


def logistic(margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss of signed margins and its derivative."""
    return np.logaddexp(0.0, -margin), -1.0 / (1.0 + np.exp(np.minimum(margin, 700.0)))


def _partial(shared):
    """Summed losses and gradients of one task's rows, as one array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        c, d = weights.shape[0], weights.shape[1] - 1
        total, seen = np.zeros((c, d + 2)), False
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            sign = 2.0 * batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, c) - 1.0
            value, slope = logistic(sign * (x @ weights[:, :d].T + weights[:, d]))
            slope = slope * sign
            total[:, :d] += slope.T @ x
            total[:, d] += slope.sum(axis=0)
            total[:, d + 1] += value.sum(axis=0)
            seen = True
        if seen:
            yield pa.RecordBatch.from_pylist([{"v": total.ravel().tolist()}])

    return run


def evaluate(rows: DataFrame, n: int, weights: np.ndarray, penalty: float):
    """Mean loss plus ``penalty / 2`` times the squared weights, and its gradient, per category."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)
    partial = rows.mapInArrow(_partial(shared), "v array<double>")
    total = Summarizer.metrics("sum").summary(F.col("v")).alias("s")
    # Two levels, so that no task and not the driver meets one row per task of a large job.
    grouped = partial.select(array_to_vector("v").alias("v"), F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("g"))
    sums = grouped.groupBy("g").agg(total).select(F.col("s.sum").alias("v")).agg(total).first()["s"]["sum"]
    shared.destroy()
    c, d = weights.shape[0], weights.shape[1] - 1
    found = sums.toArray().reshape(c, d + 2) / n
    value = found[:, d + 1] + penalty / 2 * (weights[:, :d] ** 2).sum(axis=1)
    gradient = found[:, : d + 1].copy()
    gradient[:, :d] += penalty * weights[:, :d]
    return value, gradient


@dataclass
class Descent:
    """One category's L-BFGS: where it is, where it looks next, what it remembers."""

    at: np.ndarray
    value: float
    gradient: np.ndarray
    tolerance: float
    pairs: list = field(default_factory=list)
    step: float = 1.0
    done: bool = False

    def __post_init__(self) -> None:
        self._aim()

    def _aim(self) -> None:
        """A new direction from the remembered curvature (two-loop recursion)."""
        if np.abs(self.gradient).max() <= self.tolerance:
            self.done = True
        q, back = self.gradient.copy(), []
        for s, y in reversed(self.pairs):
            rate = s @ q / (s @ y)
            back.append(rate)
            q -= rate * y
        if self.pairs:
            s, y = self.pairs[-1]
            q *= s @ y / (y @ y)
        for (s, y), rate in zip(self.pairs, reversed(back)):
            q += (rate - y @ q / (s @ y)) * s
        self.direction = -q
        if self.direction @ self.gradient >= 0:
            self.direction, self.pairs = -self.gradient, []
        self.step = 1.0 if self.pairs else min(1.0, 1.0 / max(np.linalg.norm(self.gradient), 1e-12))

    def trial(self) -> np.ndarray:
        return self.at if self.done else self.at + self.step * self.direction

    def tell(self, value: float, gradient: np.ndarray) -> None:
        """Take the value at the trial point: accept it or halve the step."""
        if self.done:
            return
        if value > self.value + 1e-4 * self.step * (self.direction @ self.gradient):
            self.step /= 2
            # No better point along this direction within what doubles can tell.
            self.done = self.step < 1e-10
            return
        s, y = self.step * self.direction, gradient - self.gradient
        if s @ y > 1e-12 * np.linalg.norm(s) * np.linalg.norm(y):
            self.pairs = [*self.pairs[1 - MEMORY :], (s, y)] if len(self.pairs) >= MEMORY else [*self.pairs, (s, y)]
        self.at, self.value, self.gradient = self.at + s, value, gradient
        self._aim()


def minimise(rows: DataFrame, n: int, start: np.ndarray, penalty: float, tolerance: float, max_jobs: int):
    """Weights of every category and the number of jobs that it took."""
    values, gradients = evaluate(rows, n, start, penalty)
    each = [Descent(w, v, g, tolerance) for w, v, g in zip(start, values, gradients)]
    jobs = 1
    while jobs < max_jobs and not all(a.done for a in each):
        trials = np.array([a.trial() for a in each])
        values, gradients = evaluate(rows, n, trials, penalty)
        for a, v, g in zip(each, values, gradients):
            a.tell(v, g)
        jobs += 1
    return np.array([a.at for a in each]), jobs


def joint_weights(
    train: DataFrame,
    names: list[str],
    penalty: float | None = None,
    tolerance: float = 1e-6,
    max_jobs: int = 200,
) -> tuple[np.ndarray, int]:
    """``(C x (d + 1) weights with the intercepts last, jobs)``; ``penalty`` is 1 / n by default."""
    rows = materialize(train.select(vector_to_array("features").alias("x"), indicator(names).alias("y")), "joint-rows")
    n = rows.count()
    width = len(rows.first()["x"])
    require_broadcastable(len(names) * (width + 2), "weights of all categories")
    start = np.zeros((len(names), width + 1))
    return minimise(rows, n, start, 1.0 / n if penalty is None else penalty, tolerance, max_jobs)


def logistic_regression(data: DataFrame, names: list[str], test_fold: int | None = 2) -> DataFrame:
    """Predictions of all categories' logistic regressions (C = 1, intercept not penalised).

    The score is a probability, like that of the models fitted one by one.
    """
    train, test = split(data, test_fold)
    weights, _ = joint_weights(train, names)
    scored = score_rows(test, names, weights[:, :-1], weights[:, -1])
    return scored.withColumn("score", 1.0 / (1.0 + F.exp(-F.col("score"))))
