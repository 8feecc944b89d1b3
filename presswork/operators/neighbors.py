"""Exact nearest-neighbour and radius search without a cross join.

Points are assigned to the nearest of P pivots. The triangle inequality tells
which cells can hold a neighbour of a query, so a query meets those cells only.
Within a cell both sides are cut into blocks of bounded size, however many
points share the cell; a task compares one pair of blocks and emits its result,
never its pairs of points. Equal vectors are collapsed before the search.
(Voronoi partitioning after Lu, Shen, Chen & Ooi, PVLDB 2012.)
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from presswork.functions.maths import hash_key
from presswork.session import materialize, require_broadcastable

BLOCK = 2048  # rows per block side
SLACK = 1e-9
# A query that meets more cells than this is sent to groups of cells instead, about as many.
MEETINGS = 16
SIDE_VALUES = 1 << 22  # doubles on a side of a pair of groups
CHUNK_PAIRS = 1 << 22  # pairs measured at a time inside a task


@dataclass
class Cells:
    """Pivots and per-cell summaries; P rows, small enough for every task."""

    pivots: np.ndarray  # (P, d)
    count: np.ndarray  # (P,)
    near: np.ndarray  # (P,) smallest distance of a member to its pivot
    far: np.ndarray  # (P,) largest
    first: np.ndarray  # (P, k) k smallest, padded with inf


def _matrix(series) -> np.ndarray:
    return np.vstack(series.to_numpy()).astype("float64")


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(d2, 0.0))


def choose_pivots(points: DataFrame, n_points: int, seed: int = 42, limit: int = 1024) -> np.ndarray:
    """A reproducible sample of distinct points; about sqrt(n), at most ``limit``."""
    wanted = max(1, min(limit, int(math.sqrt(n_points) / 2)))
    rows = points.orderBy(hash_key(F.col("id"), seed), "id").limit(wanted).select("vec").collect()
    pivots = np.unique(np.array([r["vec"] for r in rows], dtype="float64"), axis=0)
    require_broadcastable(pivots.size, "pivots")
    return pivots


def assign_cells(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add ``cell`` and ``to_pivot`` to ``(id, vec, ...)``."""
    shared = points.sparkSession.sparkContext.broadcast(pivots)

    @F.pandas_udf("cell int, to_pivot double")
    def nearest(vec: pd.Series) -> pd.DataFrame:
        d = _distances(_matrix(vec), shared.value)
        cell = d.argmin(1)
        return pd.DataFrame({"cell": cell.astype("int32"), "to_pivot": d[np.arange(len(d)), cell]})

    return points.withColumn("_c", nearest("vec")).select("*", "_c.cell", "_c.to_pivot").drop("_c")


def summarise(assigned: DataFrame, pivots: np.ndarray, k: int) -> Cells:
    """Count, range and the k smallest pivot distances of each cell (P x k numbers)."""
    p = len(pivots)
    count, near, far = np.zeros(p, "int64"), np.full(p, np.inf), np.full(p, -np.inf)
    first = np.full((p, k), np.inf)
    order = W.partitionBy("cell").orderBy("to_pivot")
    for r in (
        assigned.groupBy("cell")
        .agg(F.count("*").alias("n"), F.min("to_pivot").alias("lo"), F.max("to_pivot").alias("hi"))
        .collect()
    ):
        count[r["cell"]], near[r["cell"]], far[r["cell"]] = r["n"], r["lo"], r["hi"]
    if k:
        ranked = assigned.select("cell", "to_pivot", F.row_number().over(order).alias("r"))
        for r in ranked.where(F.col("r") <= k).collect():
            first[r["cell"], r["r"] - 1] = r["to_pivot"]
    return Cells(pivots, count, near, far, first)


def candidate_cells(queries: DataFrame, cells: Cells, k: int = 0, radius: float | None = None) -> DataFrame:
    """``(id, vec, ..., cell)`` for every cell that may hold a wanted neighbour.

    With ``k`` the radius is each query's own upper bound on the distance of
    its k-th neighbour, taken from the cell summaries.
    """
    return queries.withColumn("cell", F.explode(_reachable(queries, cells, k, radius)("vec")))


def _reachable(queries: DataFrame, cells: Cells, k: int, radius: float | None):
    shared = queries.sparkSession.sparkContext.broadcast(cells)
    total = int(cells.count.sum())

    @F.pandas_udf("array<int>")
    def reachable(vec: pd.Series) -> pd.Series:
        c = shared.value
        x = _matrix(vec)
        out = []
        apart = _distances(c.pivots, c.pivots)
        for at in range(0, len(x), 512):
            d = _distances(x[at : at + 512], c.pivots)
            if radius is not None:
                reach = np.full(len(d), radius)
            elif total <= k:
                reach = np.full(len(d), np.inf)
            else:
                bound = (d[:, :, None] + c.first[None, :, :]).reshape(len(d), -1)
                reach = np.partition(bound, k - 1, axis=1)[:, k - 1]
            reach = reach * (1 + SLACK) + SLACK * (1 + d.max(1))
            gap = np.maximum(np.maximum(d - c.far, c.near - d), 0.0)
            own = d.argmin(1)
            between = apart[own]
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = (d**2 - d[np.arange(len(d)), own][:, None] ** 2) / (2 * between)
            plane = np.where(between > 0, plane, 0.0)
            keep = (np.maximum(gap, plane) <= reach[:, None]) & (c.count > 0)
            out += [np.flatnonzero(row).astype("int32") for row in keep]
        return pd.Series(out)

    return reachable


def meetings(
    queries: DataFrame, assigned: DataFrame, cells: Cells, k: int = 0, radius: float | None = None
) -> tuple[DataFrame, DataFrame, dict]:
    """Both sides of a ``block_join``, and its block size if other than usual.

    In many dimensions a query may meet nearly every cell, and the number of cells grows with the
    points. Then cells are joined to groups, and the query goes once to each group with a cell that
    it meets. A group holds about a sixteenth of the points, as long as a task can hold that.
    """
    reach = queries.withColumn("cells", _reachable(queries, cells, k, radius)("vec"))
    reach = materialize(reach, "reach")
    met = reach.agg(F.avg(F.size("cells"))).first()[0] or 0.0
    if met <= MEETINGS:
        return reach.withColumn("cell", F.explode("cells")).drop("cells"), assigned, {}
    total, width = int(cells.count.sum()), cells.pivots.shape[1]
    side = max(BLOCK, min(math.ceil(1.25 * total / MEETINGS), SIDE_VALUES // width))
    group = F.array(*[F.lit(int(g)) for g in cell_groups(cells, side)])
    groups = F.array_distinct(F.transform("cells", lambda c: F.get(group, c)))
    grouped = assigned.withColumn("cell", F.get(group, F.col("cell")))
    return reach.withColumn("cell", F.explode(groups)).drop("cells"), grouped, {"block": side}


def cell_groups(cells: Cells, rows: int) -> np.ndarray:
    """The group of every cell: near cells together, at most ``rows`` points unless it is one cell."""
    group = np.zeros(len(cells.count), "int32")
    todo, found = [np.arange(len(group))], 0
    while todo:
        part = todo.pop()
        if len(part) == 1 or cells.count[part].sum() <= rows:
            group[part] = found
            found += 1
            continue
        widest = np.ptp(cells.pivots[part], axis=0).argmax()
        part = part[np.argsort(cells.pivots[part, widest], kind="stable")]
        before = cells.count[part].cumsum()
        at = int(np.clip(np.searchsorted(before, before[-1] / 2) + 1, 1, len(part) - 1))
        todo += [part[at:], part[:at]]
    return group


def block_join(queries: DataFrame, points: DataFrame, kernel, schema: str, block: int = BLOCK) -> DataFrame:
    """Run ``kernel(queries, points)`` on every pair of blocks that share a cell.

    Both inputs have ``id`` and ``cell``. A cell with n queries and m points is
    cut into ceil(n/block) x ceil(m/block) pairs by a hash of the id; the block
    counts table has one row per cell and is the broadcast side.
    """

    def sizes(df, name):
        return df.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias(name))

    grid = materialize(sizes(queries, "nq").join(sizes(points, "np"), "cell"), "grid")

    def cut(df, own, other, own_name, other_name):
        part = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        placed = df.join(F.broadcast(grid), "cell")
        # Fresh aliases: both sides may stem from the same stored table.
        kept = [F.col(c).alias(c) for c in df.columns]
        return placed.select(*kept, part.alias(own_name), copies.alias(other_name))

    left = cut(queries, "nq", "np", "qb", "pb")
    right = cut(points, "np", "nq", "pb", "qb")
    keys = ("cell", "qb", "pb")
    return (
        left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(kernel, schema)
    )


def first_of_equal(points: DataFrame, k: int) -> DataFrame:
    """At most the k lowest ids of each distinct vector: no other can rank.

    The rank limit is applied before the shuffle as well, so a vector with very
    many copies never gathers in one task.
    """
    order = W.partitionBy("vec").orderBy("id")
    return points.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).drop("_r")


def _id_type(df: DataFrame) -> str:
    return df.schema["id"].dataType.simpleString()


def knn_join(
    queries: DataFrame, points: DataFrame, k: int = 5, seed: int = 42, exclude_self: bool = False
) -> DataFrame:
    """``(id, neighbor, distance, rank)``: the k nearest points of every query.

    Inputs are ``(id, vec array<double>)``. Ties go to the lower id.
    ``exclude_self`` drops the point that has the query's own id.
    """
    want = k + 1 if exclude_self else k
    kept = materialize(first_of_equal(points.select("id", "vec"), want), "points")
    n_points = kept.count()
    pivots = choose_pivots(kept, n_points, seed)
    assigned = materialize(assign_cells(kept, pivots), "cells")
    cells = summarise(assigned, pivots, want)
    distinct = queries.groupBy("vec").agg(F.min("id").alias("id"))
    reach, placed, size = meetings(distinct, assigned.select("id", "vec", "cell"), cells, k=want)

    hits = block_join(
        reach,
        placed,
        nearest_rows(want),
        f"id {_id_type(queries)}, neighbor {_id_type(points)}, distance double",
        **size,
    )
    return lists_of_all(top_k(hits, want), distinct, queries, k, exclude_self)


def nearest_rows(want: int):
    """Kernel for ``block_join``: the ``want`` nearest points of every query of a block."""

    def nearest(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if q.empty or p.empty:
            return pd.DataFrame({"id": [], "neighbor": [], "distance": []})
        x, y = _matrix(q["vec"]), _matrix(p["vec"])
        scale = 1.0 + (y * y).sum(1).max()
        parts = []
        step = max(1, min(256, CHUNK_PAIRS // len(y)))
        for at in range(0, len(x), step):
            xs = x[at : at + step]
            d2 = (xs * xs).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (xs @ y.T)
            kth = np.partition(d2, min(want, len(y)) - 1, axis=1)[:, min(want, len(y)) - 1]
            # Shortlist with a margin for rounding, then measure exactly.
            qi, pi = np.nonzero(d2 <= (kth + 1e-10 * ((xs * xs).sum(1) + scale))[:, None])
            exact = np.sqrt(((xs[qi] - y[pi]) ** 2).sum(1))
            parts.append(
                pd.DataFrame(
                    {
                        "id": q["id"].to_numpy()[at + qi],
                        "neighbor": p["id"].to_numpy()[pi],
                        "distance": exact,
                    }
                )
            )
        found = pd.concat(parts).sort_values(["id", "distance", "neighbor"])
        return found[found.groupby("id").cumcount() < want]

    return nearest


def lists_of_all(best: DataFrame, distinct: DataFrame, queries: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """Every query takes over the list of the one of ``distinct`` that stands for its vector."""
    lists = best.groupBy("id").agg(F.collect_list(F.struct("neighbor", "distance")).alias("l"))
    by_vector = distinct.join(lists, "id").select("vec", "l")
    rows = queries.select("id", "vec").join(by_vector, "vec").select("id", F.inline("l"))
    if exclude_self:
        rows = rows.where(F.col("neighbor") != F.col("id"))
    return top_k(rows, k)


def top_k(hits: DataFrame, k: int) -> DataFrame:
    """The k nearest rows per query, ties to the lower neighbour id."""
    order = W.partitionBy("id").orderBy("distance", "neighbor")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("id", "neighbor", "distance", "rank")
    )


def points_of(df: DataFrame, features: str = "features", key: str = "doc_id") -> DataFrame:
    """``(id, vec)`` from a feature table with vectors or arrays."""
    from pyspark.ml.functions import vector_to_array

    column = F.col(features)
    if not isinstance(df.schema[features].dataType, T.ArrayType):
        column = vector_to_array(column)
    return df.select(F.col(key).alias("id"), column.cast("array<double>").alias("vec"))
