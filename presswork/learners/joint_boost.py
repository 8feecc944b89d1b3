"""AdaBoost (real-valued form) of all categories, one histogram job a round.

Features are cut into bins once. A round sums, in one job, the weights and the positive weights of
every (category, feature, bin); the best stump of each category follows from these sums, so
the number of jobs is that of the rounds, whatever the number of categories. The weights of a round
are a function of the stumps so far and are computed where the rows are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from presswork.learners.boosting import TINY
from presswork.learners.relevance import split
from presswork.operators.categories import has_category, indicator
from presswork.session import materialize, require_broadcastable

BINS = 64
GROUPS = 64

# feature, last bin of the low side, half log odds of the low side and of the high side
Stump = tuple[int, int, float, float]


def feature_cuts(rows: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """Per feature the ascending values that part its bins (quantiles of all rows)."""
    shares = [k / bins for k in range(1, bins)]
    cells = rows.select(F.posexplode("x").alias("f", "v"))
    found = cells.groupBy("f").agg(F.percentile_approx("v", shares, 10_000).alias("cuts"), F.max("v").alias("top")).collect()
    ordered = sorted(found, key=lambda r: r["f"])
    # A cut at the largest value would leave nothing above it.
    return [np.unique([c for c in r["cuts"] if c < r["top"]]) for r in ordered]


def binned(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """``(b, y)``: a byte per feature and a byte per category of every row."""
    shared = rows.sparkSession.sparkContext.broadcast(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            y = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.uint8)
            b = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(shared.value)], axis=1).astype(np.uint8)
            rows = {"b": [r.tobytes() for r in b], "y": [r.tobytes() for r in y]}
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("b", pa.binary()), ("y", pa.binary())]))

    return materialize(rows.mapInArrow(run, "b binary, y binary"), "boost-bins")


def margins(b: np.ndarray, ensembles: list[list[Stump]]) -> np.ndarray:
    """Sum of half log odds of every row (a bin per feature) and category."""
    out = np.zeros((len(b), len(ensembles)))
    for c, stumps in enumerate(ensembles):
        for feature, last, low, high in stumps:
            out[:, c] += np.where(b[:, feature] <= last, low, high)
    return out


def _histogram(shared, bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ensembles, active, d = shared.value
        total = np.zeros((len(active), 2, d * bins))
        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            b = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, d)
            y = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(len(b), -1)[:, active]
            sign = 2.0 * y - 1.0
            w = np.exp(np.clip(-sign * margins(b, [ensembles[c] for c in active]), -300.0, 300.0))
            place = (b + bins * np.arange(d)).ravel()
            for i in range(len(active)):
                total[i, 0] += np.bincount(place, np.repeat(w[:, i], d), d * bins)
                total[i, 1] += np.bincount(place, np.repeat(w[:, i] * y[:, i], d), d * bins)
            seen = True
        if seen:
            yield pa.RecordBatch.from_pydict({"v": [total.ravel().tolist()]})

    return run


def weight_sums(rows: DataFrame, ensembles: list, active: list[int], d: int, bins: int) -> np.ndarray:
    """(active categories x 2 x features x bins): weights and positive weights of this round."""
    shared = rows.sparkSession.sparkContext.broadcast((ensembles, active, d))
    partial = rows.mapInArrow(_histogram(shared, bins), "v array<double>")
    total = Summarizer.metrics("sum").summary(F.col("v")).alias("s")
    # Two levels: neither one task nor the driver meets a row per task of a large job.
    grouped = partial.select(array_to_vector("v").alias("v"), F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("g"))
    sums = grouped.groupBy("g").agg(total).select(F.col("s.sum").alias("v")).agg(total).first()["s"]["sum"]
    shared.destroy()
    return sums.toArray().reshape(len(active), 2, d, bins)


def half_odds(share: float) -> float:
    return 0.5 * (math.log(max(share, TINY)) - math.log(max(1.0 - share, TINY)))


def best_stump(weights: np.ndarray, positive: np.ndarray) -> Stump:
    """The split of least variance of the 0/1 target; without a useful one, a constant stump."""
    w, p = weights[0].sum(), positive[0].sum()
    left, left_p = weights.cumsum(axis=1)[:, :-1], positive.cumsum(axis=1)[:, :-1]
    right, right_p = w - left, p - left_p
    usable = (left > 1e-12 * w) & (right > 1e-12 * w)
    gain = np.where(usable, left_p**2 / np.where(usable, left, 1) + right_p**2 / np.where(usable, right, 1), -1.0)
    feature, last = np.unravel_index(gain.argmax(), gain.shape)
    if gain[feature, last] <= p * p / w * (1 + 1e-12):
        constant = half_odds(p / w)
        return 0, 0, constant, constant
    at = feature, last
    return int(feature), int(last), half_odds(left_p[at] / left[at]), half_odds(right_p[at] / right[at])


def boost(train: DataFrame, names: list[str], rounds: int = 50, bins: int = BINS) -> tuple[list[list[Stump]], list[np.ndarray], int]:
    """The stumps of every category, the cuts of the features and the number of histogram jobs."""
    rows = train.select(vector_to_array("features").alias("x"), indicator(names).alias("y"))
    cuts = feature_cuts(rows, bins)
    d = len(cuts)
    require_broadcastable(2 * len(names) * d * bins, "histograms of all categories")
    rows = binned(rows, cuts)
    ensembles: list[list[Stump]] = [[] for _ in names]
    active, jobs = list(range(len(names))), 0
    pure = half_odds(1.0)
    while active and jobs < rounds:
        sums = weight_sums(rows, ensembles, active, d, bins)
        jobs += 1
        going = []
        for c, (weights, positive) in zip(active, sums):
            stump = best_stump(weights, positive)
            _, _, low, high = stump
            constant = low == high
            if not constant or not ensembles[c]:
                ensembles[c].append(stump)
            parted = min(abs(low), abs(high)) >= pure - 1e-9 and low * high < 0
            if not constant and not parted:
                going.append(c)
        active = going
    return ensembles, cuts, jobs


def adaboost(data: DataFrame, names: list[str], test_fold: int | None = 2, rounds: int = 50) -> DataFrame:
    """Predictions of boosted stumps for every category."""
    train, test = split(data, test_fold)
    ensembles, cuts, _ = boost(train, names, rounds)
    shared = data.sparkSession.sparkContext.broadcast((ensembles, cuts))

    @F.pandas_udf("array<double>")
    def scores(features: pd.Series) -> pd.Series:
        stumps, parts = shared.value
        x = np.vstack(features.to_numpy())
        b = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(parts)], axis=1)
        return pd.Series(list(margins(b, stumps)))

    labels = F.array(*[has_category(n) for n in names])
    scored = test.select("doc_id", labels.alias("y"), scores(vector_to_array("features")).alias("s"))
    flat = scored.select("doc_id", "y", F.posexplode("s").alias("category_idx", "score"))
    return flat.select(
        "doc_id",
        "category_idx",
        F.get("y", F.col("category_idx")).alias("label"),
        "score",
        (F.col("score") > 0).cast("double").alias("prediction"),
    )
