"""k-means and BIRCH-style micro-clustering."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from presswork.operators.neighbors import BLOCK, assign_cells, choose_pivots, points_of
from presswork.session import materialize


def kmeans_model(
    data: DataFrame, k: int, init: str = "random", seed: int = 42, starts: int = 10
) -> KMeansModel:
    """The cheapest of ``starts`` runs with consecutive seeds.

    ``init`` is ``random`` or ``k-means||`` (the distributed k-means++).
    """
    rows = data.select("features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows.count()

        def run(s: int) -> KMeansModel:
            return KMeans(k=k, initMode=init, seed=s, maxIter=100, featuresCol="features").fit(rows)

        with ThreadPoolExecutor(4) as pool:
            models = list(pool.map(run, range(seed, seed + starts)))
        return min(models, key=lambda m: m.summary.trainingCost)
    finally:
        rows.unpersist()


def kmeans(data: DataFrame, k: int, init: str = "random", seed: int = 42, starts: int = 10) -> DataFrame:
    model = kmeans_model(data, k, init, seed, starts)
    return model.transform(data).select("doc_id", F.col("prediction").alias("cluster"))


def birch(data: DataFrame, k: int, threshold: float = 0.01, seed: int = 42) -> DataFrame:
    """Micro-clusters of radius at most ``threshold``, then weighted k-means.

    Nearby points share a cell; each block of a cell absorbs its points one by
    one into the nearest micro-cluster that stays within the radius. Only
    (count, mean) per micro-cluster takes part in the global step.
    """
    points = materialize(points_of(data), "points")
    pivots = choose_pivots(points, points.count(), seed)
    assigned = materialize(assign_cells(points, pivots), "cells")
    blocks = assigned.groupBy("cell").agg(
        F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("nb")
    )
    placed = assigned.join(F.broadcast(blocks), "cell").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int")
    )
    id_type = points.schema["id"].dataType.simpleString()
    micro = materialize(
        placed.select("cell", "block", "id", "vec")
        .groupBy("cell", "block")
        .applyInPandas(
            lambda pdf: _absorb(pdf, threshold),
            f"id {id_type}, vec array<double>, cell int, block int, micro int",
        ),
        "micro",
    )
    keys = ["cell", "block", "micro"]
    summary = micro.groupBy(*keys).agg(
        F.count("*").cast("double").alias("n"),
        Summarizer.mean(array_to_vector("vec")).alias("features"),
    )
    summary = materialize(summary, "summary")
    model = KMeans(k=k, initMode="k-means||", seed=seed, maxIter=100, weightCol="n").fit(summary)
    owner = model.transform(summary).select(*keys, F.col("prediction").alias("cluster"))
    return micro.join(owner, keys).select(F.col("id").alias("doc_id"), "cluster")


def _absorb(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Leader pass over one block; a micro-cluster is (count, sum, sum of squares)."""
    pdf = pdf.sort_values("id")
    x = np.vstack(pdf["vec"].to_numpy())
    count = np.zeros(len(x))
    total = np.zeros_like(x)
    square = np.zeros(len(x))
    micro = np.zeros(len(x), dtype="int32")
    used = 0
    for i, row in enumerate(x):
        best = -1
        if used:
            means = total[:used] / count[:used, None]
            best = int(((means - row) ** 2).sum(1).argmin())
            n = count[best] + 1
            s = total[best] + row
            radius2 = (square[best] + row @ row) / n - (s @ s) / n**2
            if radius2 > threshold**2:
                best = -1
        if best < 0:
            best, used = used, used + 1
        count[best] += 1
        total[best] += row
        square[best] += row @ row
        micro[i] = best
    return pdf.assign(micro=micro)[["id", "vec", "cell", "block", "micro"]]
