"""Tables behind the plots: decision grids and cluster maps."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F


def decision_grid(points: DataFrame, step: float = 0.02, margin: float = 1.0) -> DataFrame:
    """Mesh points over the first two dimensions' range, ``margin`` wider.

    ``(ix, iy, features)``. One range of cell numbers is split into rows and
    columns by division, so the mesh is generated in parallel without a join.
    """
    stats = Summarizer.metrics("min", "max").summary(F.col("features"))
    bounds = points.select(stats.alias("s")).first()["s"]
    low = [float(bounds["min"][i]) - margin for i in range(2)]
    high = [float(bounds["max"][i]) + margin for i in range(2)]
    nx, ny = (_steps(low[i], high[i], step) for i in range(2))
    cells = points.sparkSession.range(nx * ny)
    ix = F.floor(F.col("id") / ny).cast("int")
    iy = F.pmod("id", F.lit(ny)).cast("int")
    mesh = cells.select(ix.alias("ix"), iy.alias("iy"))
    at = F.array(low[0] + F.col("ix") * step, low[1] + F.col("iy") * step)
    return mesh.select("ix", "iy", array_to_vector(at).alias("features"))


def _steps(low: float, high: float, step: float) -> int:
    """Number of values low, low+step, ... below high."""
    import math

    return max(0, math.ceil((high - low) / step))


def cluster_map(model, data: DataFrame) -> DataFrame:
    """Points with their cluster, and the centroids, in one table."""
    points = model.transform(data).select(
        F.lit("point").alias("kind"),
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("prediction").alias("cluster"),
        vector_to_array("features").alias("position"),
    )
    centers = data.sparkSession.createDataFrame(
        [("centroid", None, i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())],
        "kind string, doc_id string, cluster int, position array<double>",
    )
    return points.unionByName(centers)
