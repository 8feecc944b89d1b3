"""Approximate nearest neighbours by random projections, exactly ranked.

Each of ``tables`` hash tables cuts the space with ``bits`` random hyperplanes
through the mean. A point has one bucket per table; a query also looks into the
buckets across the planes that it lies nearest to (query-directed probing after
Lv, Josephson, Wang, Charikar & Li, VLDB 2007). What shares a bucket is compared
by true distance, in pairs of blocks of bounded size, however full a bucket is;
the best of all buckets are ranked as ``knn_join`` ranks them. So a distance is
never wrong, and a neighbour can be missing; ``recall`` tells how many are.

How many buckets a query must look into grows with the table. ``Index.probes_for``
doubles their number until a bounded sample of points, searched exactly for once,
finds the wanted share of its true neighbours.

Defined cases: a query whose buckets are all empty has no rows; fewer points in
its buckets than wanted give fewer rows; equal vectors share their buckets and
rank by id; an empty side gives an empty result.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from presswork.functions.maths import hash_key
from presswork.operators.neighbors import (
    _id_type, _matrix, block_join, first_of_equal, knn_join, lists_of_all, nearest_rows, top_k,
)
from presswork.session import materialize, require_broadcastable

BUCKET = 256  # points of a bucket, on average
MAX_BITS = 24
SAMPLE = 200  # points that the number of probes is chosen by
MARGIN = 0.04  # what the sample must find beyond the wanted recall


class Planes:
    """``tables`` x ``bits`` directions and the point that all planes go through."""

    def __init__(self, mean: np.ndarray, tables: int, bits: int, seed: int):
        self.tables, self.bits = tables, bits
        self.directions = np.random.default_rng(seed).normal(size=(len(mean), tables * bits))
        self.directions /= np.linalg.norm(self.directions, axis=0)
        self.offset = mean @ self.directions

    def sides(self, x: np.ndarray) -> np.ndarray:
        """Signed distances to the planes: rows x tables x bits."""
        return (x @ self.directions - self.offset).reshape(len(x), self.tables, self.bits)

    def codes(self, sides: np.ndarray) -> np.ndarray:
        """The bucket of each row in each table; tables do not share numbers."""
        own = ((sides > 0) << np.arange(self.bits)).sum(2).astype("int64")
        return own + (np.arange(self.tables, dtype="int64") << self.bits)

    def flips(self) -> list[tuple[int, ...]]:
        """Sets of planes that a probe may cross: up to three at once."""
        return [c for size in (1, 2, 3) for c in itertools.combinations(range(self.bits), size)]

    def probes(self, sides: np.ndarray, n: int) -> np.ndarray:
        """Buckets to look into: the own one and the ``n - 1`` with the least squared way across planes."""
        own = self.codes(sides)
        flips = self.flips()
        if n <= 1:
            return own
        crossed = np.zeros((len(flips), self.bits))
        for i, planes in enumerate(flips):
            crossed[i, list(planes)] = 1.0
        masks = (crossed.astype("int64") << np.arange(self.bits)).sum(1)
        way = np.einsum("rtb,fb->rtf", sides**2, crossed)
        more = min(n - 1, len(flips))
        near = np.argpartition(way, more - 1, axis=2)[:, :, :more]
        across = own[:, :, None] ^ masks[near]
        return np.concatenate([own[:, :, None], across], axis=2).reshape(len(own), -1)


def choose_planes(points: DataFrame, n_points: int, tables: int, bucket: int, seed: int) -> Planes | None:
    """Planes for buckets of about ``bucket`` points; None for an empty table."""
    sums = points.select(F.posexplode("vec").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("m"))
    mean = np.array([r["m"] for r in sums.orderBy("at").collect()])
    if not n_points:
        return None
    bits = min(MAX_BITS, max(1, math.ceil(math.log2(max(2.0, n_points / bucket)))))
    require_broadcastable(len(mean) * tables * bits, "random planes")
    return Planes(mean, tables, bits, seed)


def in_buckets(rows: DataFrame, planes: Planes, probes: int = 1) -> DataFrame:
    """``(id, vec, cell)``: one row per bucket that a row lies in or looks into."""
    shared = rows.sparkSession.sparkContext.broadcast(planes)

    @F.pandas_udf("array<bigint>")
    def buckets(vec: pd.Series) -> pd.Series:
        own, x = shared.value, _matrix(vec)
        out = []
        for at in range(0, len(x), 256):
            sides = own.sides(x[at : at + 256])
            out += list(own.probes(sides, probes))
        return pd.Series(out)

    return rows.select("id", "vec", F.explode(buckets("vec")).alias("cell"))


class Index:
    """The points in the buckets of every table, written once; searched by any number of queries."""

    def __init__(self, points: DataFrame, copies: int, tables: int = 8, bucket: int = BUCKET, seed: int = 42):
        """Of equal vectors the ``copies`` lowest ids are kept: ``k``, or ``k + 1`` to leave out the own id."""
        self.points = materialize(first_of_equal(points.select("id", "vec"), copies), "points")
        self.copies, self.seed = copies, seed
        self.planes = choose_planes(self.points, self.points.count(), tables, bucket, seed)
        self.filed = materialize(in_buckets(self.points, self.planes), "buckets") if self.planes else None

    def search(self, queries: DataFrame, k: int, probes: int, exclude_self: bool = False) -> DataFrame:
        want = k + 1 if exclude_self else k
        if want > self.copies:
            raise ValueError(f"the index keeps {self.copies} copies of a vector, fewer than {want}")
        schema = f"id {_id_type(queries)}, neighbor {_id_type(self.points)}, distance double"
        if self.planes is None:
            return queries.sparkSession.createDataFrame([], f"{schema}, rank int")
        distinct = queries.groupBy("vec").agg(F.min("id").alias("id"))
        asked = materialize(in_buckets(distinct, self.planes, probes), "asked")
        hits = block_join(asked, self.filed, nearest_rows(want), schema)
        # A point that shares several buckets with a query comes once from each.
        once = hits.groupBy("id", "neighbor").agg(F.min("distance").alias("distance"))
        return lists_of_all(top_k(once, want), distinct, queries, k, exclude_self)

    def probes_for(self, least: float, k: int, sample: int = SAMPLE) -> int | None:
        """Probes that find ``least`` of the neighbours and a margin in a sample; None if no number does."""
        if self.planes is None:
            return 1
        drawn = self.points.orderBy(hash_key(F.col("id"), self.seed), "id").limit(sample)
        drawn = materialize(drawn, "sample")
        exact = materialize(knn_join(drawn, self.points, k), "sample-near")
        most, probes = 1 + len(self.planes.flips()), 4
        while probes < 2 * most:
            found = recall(self.search(drawn, k, min(probes, most)), exact).first()["recall"]
            if found >= min(1.0, least + MARGIN):
                return min(probes, most)
            probes *= 2
        return None


def approximate_knn_join(
    queries: DataFrame,
    points: DataFrame,
    k: int = 5,
    tables: int = 8,
    probes: int | None = None,
    least: float = 0.9,
    bucket: int = BUCKET,
    seed: int = 42,
    exclude_self: bool = False,
) -> DataFrame:
    """``(id, neighbor, distance, rank)``: near points of every query, nearest first.

    As ``knn_join``, of which it gives most rows: a share of ``least``, for which the number of
    ``probes`` is chosen if none is given. A query is compared with about
    ``tables * probes * bucket`` points. Data of which no number of probes finds that share, as
    points without any structure in many dimensions, are searched exactly.
    """
    want = k + 1 if exclude_self else k
    index = Index(points, want, tables, bucket, seed)
    chosen = probes or index.probes_for(least, want)
    if chosen is None:
        return knn_join(queries, points, k, seed, exclude_self)
    return index.search(queries, k, chosen, exclude_self)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``(wanted, found, recall)``: how many of the rows of ``exact`` the rows of ``found`` stand for.

    A row of ``found`` counts if it is no farther than the farthest that ``exact`` has for its
    query, so that another point at the same distance does not count as missing.
    """
    last = exact.groupBy("id").agg(F.max("distance").alias("far"), F.count("*").alias("n"))
    near = found.join(last, "id").where("distance <= far").groupBy("id").agg(F.count("*").alias("hits"))
    counts = last.join(near, "id", "left").agg(F.sum("n").alias("wanted"), F.coalesce(F.sum("hits"), F.lit(0)).alias("found"))
    return counts.withColumn("recall", F.col("found") / F.col("wanted"))
