"""One binary model per category on a shared feature table.

``data`` always has ``doc_id, fold, features (vector), categories``. Every
learner returns ``(doc_id, category_idx, label, score, prediction)`` for the
held-out fold (or for all rows when ``test_fold`` is None).
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from presswork.operators.categories import has_category
from presswork.operators.metrics import classification_report

# Rows that are worth a partition, and the numbers (128 MB) from which on it is cut.
LEAST, MOST = 4096, 16 * 1024 * 1024

COLUMNS = ("doc_id", "category_idx", "label", "score", "prediction")


def split(data: DataFrame, test_fold: int | None) -> tuple[DataFrame, DataFrame]:
    if test_fold is None:
        return data, data
    return data.where(F.col("fold") != test_fold), data.where(F.col("fold") == test_fold)


def balanced(rows: DataFrame, n_rows: int, width: int, fits: int = 1) -> DataFrame:
    """Training rows in even partitions, so many that ``fits`` at a time use every core.

    Fits pass over the rows again and again and send sums per task (a forest 64 x 64 counts per
    node), so neither the splits of the files nor a single split should decide the number of
    tasks. Partitions hold LEAST rows to MOST numbers; tables of fewer rows stay as they are.
    """
    if n_rows <= LEAST:
        return rows
    cores = rows.sparkSession.sparkContext.defaultParallelism
    wanted = max(min(-(-cores // fits), -(-n_rows // LEAST)), -(-n_rows * width // MOST))
    return rows if rows.rdd.getNumPartitions() == wanted else rows.repartition(wanted)


def binary_relevance(
    make_estimator,
    data: DataFrame,
    names: list[str],
    test_fold: int | None = 2,
    parallelism: int = 8,
) -> DataFrame:
    """Fit ``make_estimator(n_rows, n_features)`` once per category.

    The training rows are cached once, in few even partitions; a few driver threads submit the
    fits so that their jobs share the cluster. All models then score the held-out rows
    in one scan.
    """
    models = fit_per_category(make_estimator, data, names, test_fold, parallelism)
    return predict_all(models, split(data, test_fold)[1], names)


def fit_per_category(make_estimator, data, names, test_fold=2, parallelism=8) -> list:
    train = split(data, test_fold)[0].select("features", "categories")
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_rows = train.count()
        n_features = len(train.first()["features"])
        threads = min(parallelism, len(names))
        rows = balanced(train, n_rows, n_features, threads).persist(StorageLevel.MEMORY_AND_DISK)

        def fit(name: str):
            labelled = rows.select("features", has_category(name).alias("label"))
            return make_estimator(n_rows, n_features).fit(labelled)

        try:
            with ThreadPoolExecutor(threads) as pool:
                return list(pool.map(fit, names))
        finally:
            rows.unpersist()
    finally:
        train.unpersist()


def predict_all(models: list, rows: DataFrame, names: list[str]) -> DataFrame:
    """Long predictions of every model from a single pass over ``rows``."""
    scored, lines = rows, []
    for idx, (model, name) in enumerate(zip(models, names)):
        model = model.copy()
        model.setPredictionCol(f"_p{idx}")
        model.setRawPredictionCol(f"_r{idx}")
        score = f"_r{idx}"
        if model.hasParam("probabilityCol"):
            model.setProbabilityCol(f"_q{idx}")
            score = f"_q{idx}"
        scored = model.transform(scored)
        lines.append(
            F.struct(
                F.lit(idx).alias("category_idx"),
                has_category(name).alias("label"),
                F.get(vector_to_array(score), 1).alias("score"),
                F.col(f"_p{idx}").alias("prediction"),
            )
        )
    return scored.select("doc_id", F.inline(F.array(*lines)))


def compare_classifiers(learners: dict, data: DataFrame, names: list[str], test_fold: int | None = 2) -> DataFrame:
    """Several learners on the same split: one report each, with fit seconds.

    ``learners`` maps a model name to ``f(data, names, test_fold) -> predictions``.
    """
    reports = None
    for model, learner in learners.items():
        began = time.perf_counter()
        predictions = learner(data, names, test_fold)
        seconds = time.perf_counter() - began
        report = classification_report(predictions).select(
            F.lit(model).alias("model"), "*", F.lit(seconds).alias("fit_seconds")
        )
        reports = report if reports is None else reports.unionByName(report)
    return reports
