"""One-pass sums from which the closed-form learners are solved."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from presswork.operators.categories import has_category
from presswork.session import require_broadcastable


@dataclass
class ClassMoments:
    """Counts, means and central sums of squares: overall and per category."""

    n: int
    mean: np.ndarray  # (d,)
    square: np.ndarray  # (d,) sum of squared deviations from ``mean``
    n1: np.ndarray  # (C,)
    mean1: np.ndarray  # (C, d)
    square1: np.ndarray  # (C, d) deviations from ``mean1``

    @property
    def n0(self) -> np.ndarray:
        return self.n - self.n1

    @property
    def mean0(self) -> np.ndarray:
        rest = self.n * self.mean - self.n1[:, None] * self.mean1
        return rest / np.maximum(self.n0, 1)[:, None]

    @property
    def square0(self) -> np.ndarray:
        """What is left of the total after both classes' other parts."""
        within = (
            self.square
            - self.square1
            - self.n1[:, None] * (self.mean1 - self.mean) ** 2
            - self.n0[:, None] * (self.mean0 - self.mean) ** 2
        )
        return np.maximum(within, 0.0)


def carried_categories(names: list[str]) -> Column:
    """-1 for every row, then the numbers of the categories that it carries."""
    numbers = [F.when(has_category(n) == 1.0, F.lit(i)) for i, n in enumerate(names)]
    return F.filter(F.array(F.lit(-1), *numbers), lambda i: i.isNotNull())


def class_moments(train: DataFrame, names: list[str]) -> ClassMoments:
    """Each row counts once for the total and once per category it carries.

    The complement of every category follows by subtraction, so the pass costs
    one vector per positive label instead of one per category. Partial
    aggregation absorbs categories that hold a large share of the rows.
    """
    stats = Summarizer.metrics("count", "mean", "variance").summary(F.col("features"))
    rows = (
        train.select(F.explode(carried_categories(names)).alias("c"), "features")
        .groupBy("c")
        .agg(stats.alias("s"))
        .collect()
    )
    found = {r["c"]: r["s"] for r in rows}
    total = found[-1]
    d, c = len(total["mean"]), len(names)
    require_broadcastable(2 * d * c, "class moments")
    n1, mean1, square1 = np.zeros(c), np.zeros((c, d)), np.zeros((c, d))
    for i in range(c):
        if i in found:
            s = found[i]
            n1[i] = s["count"]
            mean1[i] = s["mean"].toArray()
            square1[i] = s["variance"].toArray() * (s["count"] - 1)
    return ClassMoments(
        n=total["count"],
        mean=total["mean"].toArray(),
        square=total["variance"].toArray() * (total["count"] - 1),
        n1=n1,
        mean1=mean1,
        square1=square1,
    )


def gram(df: DataFrame, column: str = "features", center: np.ndarray | None = None) -> np.ndarray:
    """``X'X`` (about ``center``): one small matrix per task, summed by Spark."""
    d = len(df.select(column).first()[0])
    require_broadcastable(d * d, "gram matrix")
    shift = np.zeros(d) if center is None else center
    upper = np.triu_indices(d)

    def partial(batches):
        acc = np.zeros((d, d))
        for pdf in batches:
            if len(pdf):
                x = np.vstack(pdf["v"].to_numpy()) - shift
                acc += x.T @ x
        yield pd.DataFrame({"i": upper[0], "j": upper[1], "v": acc[upper]})

    vectors = df.select(vector_to_array(column).alias("v"))
    cells = (
        vectors.mapInPandas(partial, "i int, j int, v double")
        .groupBy("i", "j")
        .agg(F.sum("v").alias("v"))
        .toPandas()
    )
    out = np.zeros((d, d))
    out[cells["i"], cells["j"]] = cells["v"]
    out[cells["j"], cells["i"]] = cells["v"]
    return out


def score_rows(
    rows: DataFrame,
    names: list[str],
    weights: np.ndarray,
    intercepts: np.ndarray,
    square_weights: np.ndarray | None = None,
) -> DataFrame:
    """Long predictions of models that are linear in ``x`` (and ``x**2``).

    One matrix product per Arrow batch scores all categories at once.
    """
    require_broadcastable(weights.size * 2, "score matrix")
    shared = rows.sparkSession.sparkContext.broadcast((weights, intercepts, square_weights))

    @F.pandas_udf("array<double>")
    def scores(features: pd.Series) -> pd.Series:
        w, b, q = shared.value
        x = np.vstack(features.to_numpy())
        out = x @ w.T + b
        if q is not None:
            out = out + (x * x) @ q.T
        return pd.Series(list(out))

    scored = rows.select(
        "doc_id", "categories", scores(vector_to_array("features")).alias("s")
    )
    labels = F.array(*[has_category(n) for n in names])
    return scored.select(
        "doc_id", labels.alias("y"), F.posexplode("s").alias("category_idx", "score")
    ).select(
        "doc_id",
        "category_idx",
        F.get("y", F.col("category_idx")).alias("label"),
        "score",
        (F.col("score") > 0).cast("double").alias("prediction"),
    )
