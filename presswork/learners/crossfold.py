"""Every fold held out once, from one pass of per-fold statistics.

The sufficient statistics of a training set are those of all folds but one, so ten evaluations
need one scan for the sums and one for the scores. Moments of the other folds are merged
rather than subtracted: it costs the same and loses no digits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from presswork.learners.bayes import NEVER, gaussian_weights
from presswork.learners.moments import ClassMoments, carried_categories
from presswork.operators.categories import has_category, indicator
from presswork.operators.vectors import vector_sums
from presswork.session import materialize, require_broadcastable


def _merged(parts: list[tuple]) -> tuple:
    """``(n, mean, sum of squared deviations)`` of several such parts."""
    n = sum(p[0] for p in parts)
    mean = sum(p[0] * p[1] for p in parts) / max(n, 1)
    return n, mean, sum(p[2] + p[0] * (p[1] - mean) ** 2 for p in parts)


def fold_moments(data: DataFrame, names: list[str]) -> dict:
    """``fold -> ClassMoments`` of the rows of all other folds, from one scan."""
    stats = Summarizer.metrics("count", "mean", "variance").summary(F.col("features"))
    rows = (
        data.select("fold", F.explode(carried_categories(names)).alias("c"), "features")
        .groupBy("fold", "c")
        .agg(stats.alias("s"))
        .collect()
    )
    # One row per fold and category, as many numbers as the models have.
    found = {
        (r["fold"], r["c"]): (
            r["s"]["count"],
            r["s"]["mean"].toArray(),
            r["s"]["variance"].toArray() * (r["s"]["count"] - 1),
        )
        for r in rows
    }
    folds = sorted({fold for fold, _ in found})
    d = len(next(iter(found.values()))[1]) if found else 0
    require_broadcastable(3 * d * len(names) * max(len(folds), 1), "models of all folds")
    nothing = (0, np.zeros(d), np.zeros(d))

    def others(fold, c) -> tuple:
        return _merged([found.get((f, c), nothing) for f in folds if f != fold] or [nothing])

    out = {}
    for fold in folds:
        n, mean, square = others(fold, -1)
        each = [others(fold, c) for c in range(len(names))]
        out[fold] = ClassMoments(
            n=n,
            mean=mean,
            square=square,
            n1=np.array([e[0] for e in each], float),
            mean1=np.array([e[1] for e in each]),
            square1=np.array([e[2] for e in each]),
        )
    return out


def gaussian_nb_folds(data: DataFrame, names: list[str]) -> DataFrame:
    """Each row scored by the naive Bayes model of the other folds: ``(doc_id, fold, category_idx,
    label, score, prediction)``."""
    models = {fold: gaussian_weights(m) for fold, m in fold_moments(data, names).items() if m.n > 0}
    shared = data.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("array<double>")
    def scores(features: pd.Series, folds: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(features), dtype=object)
        x, own = np.vstack(features.to_numpy()), folds.to_numpy()
        for fold in np.unique(own):
            if fold not in shared.value:
                continue
            linear, constant, square = shared.value[fold]
            at = np.flatnonzero(own == fold)
            found = x[at] @ linear.T + constant + (x[at] * x[at]) @ square.T
            for i, row in zip(at, found):
                out.iat[i] = row
        return out

    labels = F.array(*[has_category(n) for n in names])
    scored = data.select("doc_id", "fold", labels.alias("y"), scores(vector_to_array("features"), "fold").alias("s"))
    flat = scored.select("doc_id", "fold", "y", F.posexplode("s").alias("category_idx", "score"))
    return flat.select(
        "doc_id",
        "fold",
        "category_idx",
        F.get("y", F.col("category_idx")).alias("label"),
        "score",
        (F.col("score") > 0).cast("double").alias("prediction"),
    )


def _kind() -> Column:
    return F.md5(F.to_json(F.struct("times", "marks"))).alias("kind")


def doc_kinds(docs: DataFrame, names: list[str]) -> DataFrame:
    """One row per ``doc_id``: ``times`` (its rows), ``marks`` (their number and their sums of each
    0/1 label) and ``kind``, a key of both that documents with the same labels share."""
    marked = docs.select("doc_id", F.concat(F.array(F.lit(1.0)), indicator(names)).alias("marks"))
    sums = vector_sums(marked, ["doc_id"], "marks", len(names) + 1, extra=(F.count("*").alias("times"),))
    return materialize(sums.select("*", _kind()), "doc-kinds")


def carry_kinds(rows: DataFrame, docs: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` (of ``docs``, with further columns) with the ``kind`` of their document.

    It follows from a row's own labels; only ids that occur more often are joined, by their measured size.
    """
    found = doc_kinds(docs, names)
    repeated = materialize(found.where("times > 1").select("doc_id", F.col("kind").alias("_shared")), "repeated")
    marks = F.concat(F.array(F.lit(1.0)), indicator(names)).alias("marks")
    own = rows.select(*rows.columns, marks, F.lit(1).cast("bigint").alias("times"))
    return own.join(repeated, "doc_id", "left").select(*rows.columns, F.coalesce("_shared", _kind()).alias("kind"))


def multinomial_nb_folds(
    weights: DataFrame, docs: DataFrame, dictionary: DataFrame, names: list[str], alpha: float = 1.0
) -> DataFrame:
    """Each document scored by the multinomial naive Bayes of the other folds, all folds at once.

    ``weights`` is ``(doc_id, fold, kind, term_idx, weight)``, ``kind`` from ``carry_kinds``;
    ``docs`` is ``(doc_id, fold, categories)``.
    A fold's training sums of a term are the term's sums less those of the fold. A document
    only needs terms that its own fold holds, so the model has one row per fold and term there.
    """
    c = len(names)
    y = indicator(names)
    marked = docs.select("doc_id", "fold", y.alias("y"))
    ids = doc_kinds(docs, names)
    kinds = materialize(ids.groupBy("kind").agg(F.first("times").alias("times"), F.first("marks").alias("y")), "kinds")
    # As in a join on the document, a weight without one counts nowhere.
    known = weights.where("weight > 0 AND doc_id IS NOT NULL")
    by_kind = known.groupBy("term_idx", "fold", "kind").agg(F.sum("weight").alias("weight")).join(kinds, "kind")
    counted = by_kind.withColumn("weight", F.col("weight") * F.col("times"))
    sums = materialize(vector_sums(counted, ["term_idx", "fold"], "y", c + 1, "weight"), "fold-terms")
    whole = vector_sums(sums, ["term_idx"], "y", c + 1).withColumnRenamed("y", "all")
    rest = sums.join(whole, "term_idx").select(
        "term_idx", "fold", F.zip_with("all", "y", lambda a, b: F.greatest(a - b, F.lit(0.0))).alias("t")
    )
    total = F.get("t", F.lit(0))
    contrast = F.transform(
        F.slice("t", 2, c),
        lambda w: F.log(w + alpha) - F.log(F.greatest(total - w, F.lit(0.0)) + alpha),
    )
    model = rest.select("term_idx", "fold", contrast.alias("s"))
    priors = _fold_totals(sums, marked, dictionary.count(), c, alpha)
    # The model has one row a key, evenly dealt, so its share of a task is hashed and the weights need no sort.
    test = known.select("doc_id", "term_idx", "fold", "weight").join(model.hint("shuffle_hash"), ["term_idx", "fold"])
    evidence = vector_sums(test, ["doc_id"], "s", c, "weight", extra=(F.sum("weight").alias("mass"),))
    rows = marked.join(evidence.join(ids.select("doc_id", "times"), "doc_id"), "doc_id", "left").join(F.broadcast(priors), "fold").select(
        "doc_id",
        "fold",
        F.coalesce(F.col("mass") * F.col("times"), F.lit(0.0)).alias("mass"),
        F.arrays_zip(
            F.col("y").alias("label"),
            F.coalesce(F.transform("s", lambda w: w * F.col("times")), F.array_repeat(F.lit(0.0), c)).alias("s"),
            "prior",
            "shift",
        ).alias("l"),
    )
    flat = rows.select("doc_id", "fold", "mass", F.posexplode("l").alias("category_idx", "l"))
    score = F.col("l.prior") + F.col("l.s") - F.col("mass") * F.col("l.shift")
    return flat.select(
        "doc_id",
        "fold",
        "category_idx",
        F.col("l.label").alias("label"),
        score.alias("score"),
        (score > 0).cast("double").alias("prediction"),
    )


def _fold_totals(sums: DataFrame, marked: DataFrame, terms: int, c: int, alpha: float) -> DataFrame:
    """One row per fold: log prior odds and ln(W1 + aV) - ln(W0 + aV) per category, of the other folds."""
    mass = {r["fold"]: np.array(r["y"]) for r in vector_sums(sums, ["fold"], "y", c + 1).collect()}
    counted = marked.select("fold", F.concat(F.array(F.lit(1.0)), F.col("y")).alias("y"))
    count = {r["fold"]: np.array(r["y"]) for r in vector_sums(counted, ["fold"], "y", c + 1).collect()}
    rows = []
    for fold in count:
        w = sum((m for f, m in mass.items() if f != fold), np.zeros(c + 1))
        n = sum((m for f, m in count.items() if f != fold), np.zeros(c + 1))
        with np.errstate(divide="ignore"):
            prior = np.clip(np.log(n[1:]) - np.log(n[0] - n[1:]), NEVER, -NEVER)
        inside, smooth = w[1:], alpha * terms
        shift = np.log(inside + smooth) - np.log(np.maximum(w[0] - inside, 0.0) + smooth)
        rows.append((fold, prior.tolist(), shift.tolist()))
    schema = f"fold {marked.schema['fold'].dataType.simpleString()}, prior array<double>, shift array<double>"
    return marked.sparkSession.createDataFrame(rows, schema)
