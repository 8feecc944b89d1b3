"""Gaussian and multinomial naive Bayes for all categories at once."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from presswork.learners.moments import ClassMoments, class_moments, score_rows
from presswork.learners.relevance import split
from presswork.operators.categories import indicator
from presswork.operators.vectors import vector_sums
from presswork.session import materialize

NEVER = -1e300  # score of a category without positive training rows


def gaussian_weights(m: ClassMoments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log odds as ``(weights of x, constants, weights of x**2)`` per category.

    Variances are population variances plus 1e-9 of the largest one.
    """
    smooth = 1e-9 * (m.square / m.n).max()
    n1, n0 = m.n1[:, None], m.n0[:, None]
    v1 = m.square1 / np.maximum(n1, 1) + smooth
    v0 = m.square0 / np.maximum(n0, 1) + smooth
    square = -0.5 * (1 / v1 - 1 / v0)
    linear = m.mean1 / v1 - m.mean0 / v0
    with np.errstate(divide="ignore"):
        prior = np.log(m.n1) - np.log(m.n0)
    constant = prior - 0.5 * (
        np.log(v1 / v0) + m.mean1**2 / v1 - m.mean0**2 / v0
    ).sum(axis=1)
    for absent, value in ((m.n1 == 0, NEVER), (m.n0 == 0, -NEVER)):
        square[absent], linear[absent], constant[absent] = 0.0, 0.0, value
    return linear, constant, square


def gaussian_nb(data: DataFrame, names: list[str], test_fold: int | None = 2) -> DataFrame:
    """Normal densities per class and dimension; score = log odds."""
    train, test = split(data, test_fold)
    linear, constant, square = gaussian_weights(class_moments(train, names))
    return score_rows(test, names, linear, constant, square)


# ------------------------------------------------------------- multinomial form


def term_class_sums(weights: DataFrame, labels: DataFrame, n_labels: int) -> DataFrame:
    """Per term: total weight and weight inside each category's documents.

    ``weights`` is ``(doc_id, term_idx, weight)``; ``labels`` has one 0/1 array
    ``y`` per document. One vector sum per term; partial aggregation keeps
    frequent terms from meeting in one task.
    """
    marks = F.concat(F.array(F.lit(1.0)), F.col("y")).alias("y")
    joined = weights.join(labels.select("doc_id", marks), "doc_id")
    # A zero weight adds nothing.
    positive = joined.where(F.col("weight") > 0)
    sums = vector_sums(positive, ["term_idx"], "y", n_labels + 1, "weight")
    return sums.select(
        "term_idx",
        F.get("y", F.lit(0)).alias("total"),
        F.slice("y", 2, n_labels).alias("inside"),
    )


def multinomial_nb(
    weights: DataFrame,
    docs: DataFrame,
    dictionary: DataFrame,
    names: list[str],
    test_fold: int = 2,
    alpha: float = 1.0,
) -> DataFrame:
    """Multinomial naive Bayes on raw TF-IDF rows of the training folds.

    ``weights`` is ``(doc_id, fold, term_idx, weight)``, ``docs`` is
    ``(doc_id, fold, categories)``. A term the training folds never weight gets
    the smoothed value like any other. The score is the log odds.
    """
    c = len(names)
    y = indicator(names)
    is_test = F.col("fold") == test_fold
    train_docs = docs.where(~is_test).select("doc_id", y.alias("y"))
    sums = term_class_sums(
        weights.where(~is_test).drop("fold"), train_docs, c
    )
    per_term = materialize(
        dictionary.select("term_idx").join(sums, "term_idx", "left").select(
            "term_idx",
            F.coalesce("total", F.lit(0.0)).alias("total"),
            F.coalesce("inside", F.array_repeat(F.lit(0.0), c)).alias("inside"),
        ),
        "term_sums",
    )
    # ln P(t|1) - ln P(t|0) without the class totals, which only shift documents.
    contrast = F.transform(
        "inside",
        lambda w: F.log(w + alpha) - F.log(F.greatest(F.col("total") - w, F.lit(0.0)) + alpha),
    )
    model = per_term.select("term_idx", contrast.alias("s"))
    priors = _class_totals(per_term, train_docs, c, alpha)

    test_docs = docs.where(is_test).select("doc_id", y.alias("y"))
    test = weights.where(is_test & (F.col("weight") > 0)).drop("fold").join(model, "term_idx")
    known = vector_sums(
        test, ["doc_id"], "s", c, "weight", extra=(F.sum("weight").alias("mass"),)
    )
    rows = test_docs.join(known, "doc_id", "left").select(
        "doc_id",
        "y",
        F.coalesce("mass", F.lit(0.0)).alias("mass"),
        F.coalesce("s", F.array_repeat(F.lit(0.0), c)).alias("s"),
    )
    lines = F.arrays_zip(
        F.col("y").alias("label"),
        F.col("s").alias("s"),
        F.array(*[F.lit(float(p)) for p in priors[0]]).alias("prior"),
        F.array(*[F.lit(float(p)) for p in priors[1]]).alias("shift"),
    )
    flat = rows.select("doc_id", "mass", F.posexplode(lines).alias("category_idx", "l"))
    score = F.col("l.prior") + F.col("l.s") - F.col("mass") * F.col("l.shift")
    return flat.select(
        "doc_id",
        "category_idx",
        F.col("l.label").alias("label"),
        score.alias("score"),
        (score > 0).cast("double").alias("prediction"),
    )


def _class_totals(per_term: DataFrame, train_docs: DataFrame, c: int, alpha: float):
    """Log prior odds and ln(W1 + aV) - ln(W0 + aV) per category (2 x C numbers)."""
    mass = per_term.agg(
        F.count("*").alias("v"),
        F.sum("total").alias("total"),
        Summarizer.metrics("sum").summary(array_to_vector("inside")).alias("s"),
    ).first()
    counts = train_docs.agg(
        F.count("*").alias("n"),
        Summarizer.metrics("sum").summary(array_to_vector("y")).alias("s"),
    ).first()
    n1 = counts["s"]["sum"].toArray()
    inside = mass["s"]["sum"].toArray()
    with np.errstate(divide="ignore"):
        prior = np.log(n1) - np.log(counts["n"] - n1)
    prior = np.clip(prior, NEVER, -NEVER)
    smooth = alpha * mass["v"]
    shift = np.log(inside + smooth) - np.log(np.maximum(mass["total"] - inside, 0.0) + smooth)
    return prior, shift
