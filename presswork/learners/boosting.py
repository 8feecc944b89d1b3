"""AdaBoost (real-valued form) over MLlib decision stumps."""

from __future__ import annotations

import math
import re
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, functions as F

from presswork.learners.relevance import split
from presswork.operators.categories import has_category

TINY = 2.220446049250313e-16  # probabilities are clipped here before the logarithm


def adaboost(
    data: DataFrame,
    names: list[str],
    test_fold: int | None = 2,
    rounds: int = 50,
    parallelism: int = 8,
) -> DataFrame:
    """Boosted stumps for each category.

    A fitted stump is one comparison on one feature. The row weight of a round
    is the exponential of the sum of the stumps so far, so it is a column
    expression on the cached rows and no weight table is carried along.
    """
    train, test = split(data, test_fold)
    rows = train.select(
        "features", "categories", vector_to_array("features").alias("x")
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows.count()
        with ThreadPoolExecutor(min(parallelism, len(names))) as pool:
            ensembles = list(pool.map(lambda c: _boost(rows, c, rounds), names))
    finally:
        rows.unpersist()
    scored = test.select("doc_id", "categories", vector_to_array("features").alias("x"))
    lines = [
        F.struct(
            F.lit(i).alias("category_idx"),
            has_category(name).alias("label"),
            _margin(stumps).alias("score"),
        )
        for i, (name, stumps) in enumerate(zip(names, ensembles))
    ]
    return scored.select("doc_id", F.inline(F.array(*lines))).withColumn(
        "prediction", (F.col("score") > 0).cast("double")
    )


def _margin(stumps: list[tuple]) -> Column:
    """Sum of half log odds over the stumps, folded over one array literal.

    The array is data, not code: a CASE per stump would be compiled anew in
    every round and outgrow the size limit of a generated method.
    """
    if not stumps:
        return F.lit(0.0)
    rows = ", ".join(
        f"named_struct('f', {f}, 'cut', {cut!r}D, 'low', {low!r}D, 'high', {high!r}D)"
        for f, cut, low, high in stumps
    )
    return F.aggregate(
        F.expr(f"array({rows})"),
        F.lit(0.0),
        lambda total, s: total
        + F.when(F.get("x", s["f"]) <= s["cut"], s["low"]).otherwise(s["high"]),
    )


def _boost(rows: DataFrame, category: str, rounds: int) -> list[tuple]:
    label = has_category(category)
    sign = F.when(label == 1.0, 1.0).otherwise(-1.0)
    # On a 0/1 target variance splits equal gini splits and the leaf value is the
    # weighted share of positives. (A classification stump whose leaves agree on
    # the majority would be merged into one leaf.)
    tree = DecisionTreeRegressor(maxDepth=1, maxBins=64, weightCol="w", seed=0)
    pure = -0.5 * math.log(TINY)
    stumps: list[tuple] = []
    for _ in range(rounds):
        exponent = F.greatest(F.least(-sign * _margin(stumps), F.lit(300.0)), F.lit(-300.0))
        weighted = rows.select("features", label.alias("label"), F.exp(exponent).alias("w"))
        stump = _as_case(tree.fit(weighted))
        constant = stump[2] == stump[3]
        if not constant or not stumps:
            stumps.append(stump)
        if constant:
            break
        if min(abs(stump[2]), abs(stump[3])) >= pure - 1e-9 and stump[2] * stump[3] < 0:
            break
    return stumps


def _as_case(model) -> tuple:
    """(feature, cut, half log odds at or below, half log odds above)."""
    split_text = re.search(r"feature (\d+) <= (\S+?)\)", model.toDebugString)
    size = model.numFeatures

    def half_odds(point: np.ndarray) -> float:
        p = float(model.predict(Vectors.dense(point)))
        return 0.5 * (math.log(max(p, TINY)) - math.log(max(1.0 - p, TINY)))

    if split_text is None:
        constant = half_odds(np.zeros(size))
        return 0, 0.0, constant, constant
    feature, cut = int(split_text.group(1)), float(split_text.group(2))
    low, high = np.zeros(size), np.zeros(size)
    low[feature] = cut
    high[feature] = np.nextafter(cut, np.inf)
    return feature, cut, half_odds(low), half_odds(high)
