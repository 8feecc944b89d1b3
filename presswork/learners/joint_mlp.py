"""Perceptrons of all categories in one optimiser.

Each category has the network of ``estimators.mlp`` (sigmoid units, softmax over two classes,
cross entropy) and starts from MLlib's weights. An evaluation is one job: a task multiplies its
rows with the first layers of all categories at once and returns the summed losses and gradients.
Each category runs its own L-BFGS with MLlib's memory, line search and stopping rules; all
ask for their next value in the same job, so the jobs are those of the slowest category.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Generator, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from presswork.learners import estimators
from presswork.learners.relevance import balanced, split
from presswork.operators.categories import has_category, indicator
from presswork.session import require_broadcastable

MAX_ITER = 1000
TOLERANCE = 1e-6
MEMORY = 10
STACK = 128  # MLlib averages stacks of so many rows, then the stacks of all partitions
CHUNK = 256
FLAT = 64  # from so many tasks on, sums meet in a stage before the driver

Ask = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


class SearchFailed(Exception):
    pass


# ------------------------------------------------------------------- one category


def _between(a: tuple, b: tuple) -> float:
    """The minimum of the cubic through two ``(t, value, slope)``, kept off both ends."""
    (lt, lv, ls), (rt, rv, rs) = sorted((a, b))
    with np.errstate(invalid="ignore", divide="ignore"):
        d1 = ls + rs - 3 * (lv - rv) / (lt - rt)
        d2 = np.sqrt(d1 * d1 - ls * rs)
        t = rt - (rt - lt) * (rs + d2 - d1) / (rs - ls + 2 * d2)
    low, high = lt + 0.1 * (rt - lt), lt + 0.9 * (rt - lt)
    return low if t < low else high if t > high else t


def _line(x, value, gradient, direction, step) -> Generator:
    """Strong Wolfe search along ``direction``: ``(step, value, gradient)``."""
    slope = gradient @ direction
    if slope > 0:
        raise SearchFailed
    seen = {}

    def at(t):
        found = yield x + t * direction
        seen["last"] = (t, *found)
        return t, found[0], found[1] @ direction

    def good(c):
        return abs(c[2]) <= 0.9 * abs(slope)

    low, high, t = (0.0, value, slope), None, step
    for i in range(10):
        c = yield from at(t)
        if not math.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > value + 1e-4 * t * slope or (c[1] >= low[1] and i > 0):
            high = c
            break
        if good(c):
            return seen["last"]
        if c[2] >= 0:
            low, high = c, low
            break
        low, t = c, t * 1.5
    if high is None:
        raise SearchFailed
    for _ in range(10):
        c = yield from at(_between(low, high))
        if c[1] > value + 1e-4 * c[0] * slope or c[1] >= low[1]:
            high = c
            continue
        if good(c):
            return seen["last"]
        if c[2] * (high[0] - low[0]) >= 0:
            high = low
        low = c
    raise SearchFailed


def _direction(gradient: np.ndarray, pairs: list) -> np.ndarray:
    """Two-loop recursion over ``(step, change of gradient)``, the newest last."""
    q, back = gradient.copy(), []
    scale = 1.0
    if pairs:
        s, y = pairs[-1]
        scale = s @ y / (y @ y) if y @ y else math.nan
        if not scale >= 0:
            raise SearchFailed
    for s, y in reversed(pairs):
        back.append(s @ q / (s @ y) if s @ y else math.nan)
        if math.isnan(back[-1]):
            raise SearchFailed
        q -= back[-1] * y
    q *= scale
    for (s, y), rate in zip(pairs, reversed(back)):
        q += (rate - y @ q / (s @ y)) * s
    return -q


def descend(x: np.ndarray, max_iter: int, tolerance: float) -> Ask:
    """L-BFGS that yields points, is sent ``(value, gradient)`` and returns the last point.

    It ends when 20 steps gained no more than ``tolerance`` of the first value, when the gradient
    vanishes, or when the line search fails twice in a row.
    """
    value, gradient = yield x
    first, values, pairs, steps, failed = value, [math.inf], [], 0, False
    while steps < max_iter:
        if abs(value - max(values)) <= tolerance * first:
            break
        if np.linalg.norm(gradient) <= max(tolerance * value, 1e-8):
            break
        try:
            direction = _direction(gradient, pairs)
            start = 1.0 if steps else 1.0 / np.linalg.norm(direction)
            t, new_value, new_gradient = yield from _line(x, value, gradient, direction, start)
            if t * np.linalg.norm(gradient) < 1e-10:
                raise SearchFailed
        except SearchFailed:
            if failed:
                break
            failed, pairs = True, []
            continue
        failed = False
        moved = t * direction
        pairs = [*pairs[-MEMORY + 1 :], (moved, new_gradient - gradient)]
        x, value, gradient, steps = x + moved, new_value, new_gradient, steps + 1
        values = [*values[-19:], value]
    return x


# ----------------------------------------------------------------- all categories


def stacks(rows: DataFrame, d: int, c: int) -> RDD:
    """Blocks ``(x bytes, y bytes)`` of whole stacks; only the last of a partition has a shorter stack."""

    schema = pa.schema([("x", pa.binary()), ("y", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = np.zeros((0, d)), np.zeros((0, c))

        def packed(n):
            if not (np.isfinite(x[:n]).all() and np.isfinite(y[:n]).all()):
                raise ValueError("features must be finite and labels must not be null")
            return pa.RecordBatch.from_pydict({"x": [x[:n].tobytes()], "y": [y[:n].astype(np.uint8).tobytes()]}, schema=schema)

        for batch in batches:
            x = np.vstack([x, batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)])
            y = np.vstack([y, batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, c)])
            if whole := len(x) // STACK * STACK:
                yield packed(whole)
                x, y = x[whole:], y[whole:]
        if len(x):
            yield packed(len(x))

    return rows.mapInArrow(run, "x binary, y binary").rdd.map(lambda r: (bytes(r[0]), bytes(r[1])))


def layers(weights: np.ndarray, d: int, h: int):
    """First layers side by side with their constants as last row, and what tells the outputs apart."""
    c = len(weights)
    first = weights[:, : (d + 1) * h].reshape(c, d + 1, h).transpose(1, 0, 2).reshape(d + 1, c * h)
    second = weights[:, (d + 1) * h :].reshape(c, h + 1, 2)
    return first, (second[:, :, 1] - second[:, :, 0])


def forward(x: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden units (rows x categories x units) and log odds (rows x categories) of ``x`` with its ones."""
    hidden = x @ first
    np.negative(hidden, out=hidden)
    np.minimum(hidden, 700.0, out=hidden)
    np.exp(hidden, out=hidden)
    hidden += 1.0
    np.reciprocal(hidden, out=hidden)
    hidden = hidden.reshape(len(x), len(second), -1)
    return hidden, np.einsum("nch,ch->nc", hidden, second[:, :-1]) + second[:, -1]


def partial(shared, d: int, h: int, c: int):
    """Per task: summed gradients and, last, losses of the asking categories; rows weigh 1 / their stack."""

    def run(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        weights, active = shared.value
        k = len(active)
        first, second = layers(weights, d, h)
        g1, g2, losses = np.zeros((d + 1, k * h)), np.zeros((k, h + 1)), np.zeros(k)
        seen = False
        for xs, ys in blocks:
            all_x, all_y = np.frombuffer(xs).reshape(-1, d), np.frombuffer(ys, np.uint8).reshape(-1, c)
            whole = len(all_x) // STACK * STACK
            share = np.full(len(all_x), 1.0 / STACK)
            share[whole:] = 1.0 / max(len(all_x) - whole, 1)
            for at in range(0, len(all_x), CHUNK):
                x = np.column_stack([all_x[at : at + CHUNK], np.ones(len(all_x[at : at + CHUNK]))])
                y, w = all_y[at : at + CHUNK][:, active], share[at : at + CHUNK, None]
                hidden, odds = forward(x, first, second)
                # Like MLlib's, the loss is no number once a probability vanishes; the search then halves its step.
                with np.errstate(invalid="ignore"):
                    loss = np.where(np.exp(-np.abs(odds)) > 0, np.logaddexp(0.0, np.where(y, -odds, odds)), np.nan)
                losses += (w * loss).sum(axis=0)
                slope = w * (1.0 / (1.0 + np.exp(np.minimum(-odds, 700.0))) - y)
                g2[:, :h] += np.einsum("nc,nch->ch", slope, hidden)
                g2[:, h] += slope.sum(axis=0)
                back = 1.0 - hidden
                back *= hidden
                back *= second[:, :-1]
                back *= slope[:, :, None]
                g1 += x.T @ back.reshape(len(x), -1)
            seen = True
        if seen:
            inner = g1.reshape(d + 1, k, h).transpose(1, 0, 2).reshape(k, -1)
            outer = np.stack([-g2, g2], axis=2).reshape(k, -1)
            yield np.hstack([inner, outer, losses[:, None]])

    return run


def minimise(blocks: RDD, start: np.ndarray, c: int, d: int, h: int, max_iter: int, tolerance: float) -> tuple[np.ndarray, int]:
    """Weights of every category and the number of gradient jobs."""
    n = blocks.map(lambda b: -(-len(b[0]) // (8 * d * STACK))).sum()
    depth = 1 if blocks.getNumPartitions() <= FLAT else 2
    each = [descend(start, max_iter, tolerance) for _ in range(c)]
    asked, done, jobs = {i: next(a) for i, a in enumerate(each)}, {}, 0
    while asked:
        active = sorted(asked)
        shared = blocks.context.broadcast((np.array([asked[i] for i in active]), active))
        found = blocks.mapPartitions(partial(shared, d, h, c)).treeReduce(operator.add, depth) / n
        shared.destroy()
        jobs += 1
        for i, row in zip(active, found):
            try:
                asked[i] = each[i].send((float(row[-1]), row[:-1]))
            except StopIteration as end:
                done[i] = end.value
                del asked[i]
    return np.array([done[i] for i in range(c)]), jobs


def joint_weights(train: DataFrame, names: list[str], max_iter: int = MAX_ITER, tolerance: float = TOLERANCE) -> tuple[np.ndarray, int, int]:
    """``(one row of weights per category in MLlib's order, hidden units, jobs)``."""
    train = train.select("features", "categories").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_rows, sample = train.count(), train.select("features").limit(1)
        d = len(sample.first()["features"])
        # MLlib's own starting weights: they depend on the seed and the sizes only.
        untrained = estimators.mlp(n_rows, d, 0)
        start = untrained.fit(sample.withColumn("label", F.lit(0.0))).weights.toArray()
        h = untrained.getLayers()[1]
        require_broadcastable(len(names) * len(start), "weights of all categories")
        rows = balanced(train, n_rows, d).select(vector_to_array("features").alias("x"), indicator(names).alias("y"))
        blocks = stacks(rows, d, len(names)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            weights, jobs = minimise(blocks, start, len(names), d, h, max_iter, tolerance)
        finally:
            blocks.unpersist()
    finally:
        train.unpersist()
    return weights, h, jobs


def mlp(data: DataFrame, names: list[str], test_fold: int | None = 2, max_iter: int = MAX_ITER) -> DataFrame:
    """Predictions of all categories' perceptrons; the score is a probability, as MLlib's is."""
    train, test = split(data, test_fold)
    weights, h, _ = joint_weights(train, names, max_iter)
    d = (weights.shape[1] - 2 * (h + 1)) // h - 1
    shared = data.sparkSession.sparkContext.broadcast(layers(weights, d, h))

    @F.pandas_udf("array<double>")
    def scores(features: pd.Series) -> pd.Series:
        first, second = shared.value
        out = []
        for at in range(0, len(features), CHUNK):
            x = np.vstack(features.iloc[at : at + CHUNK].to_numpy())
            _, odds = forward(np.column_stack([x, np.ones(len(x))]), first, second)
            out.extend(1.0 / (1.0 + np.exp(np.minimum(-odds, 700.0))))
        return pd.Series(out)

    labels = F.array(*[has_category(n) for n in names])
    scored = test.select("doc_id", labels.alias("y"), scores(vector_to_array("features")).alias("s"))
    flat = scored.select("doc_id", "y", F.posexplode("s").alias("category_idx", "score"))
    return flat.select(
        "doc_id",
        "category_idx",
        F.get("y", F.col("category_idx")).alias("label"),
        "score",
        (F.col("score") > 0.5).cast("double").alias("prediction"),
    )
