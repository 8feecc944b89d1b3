"""Approximate neighbour search against the exact one."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from presswork.operators import approximate
from presswork.operators.neighbors import knn_join

SCHEMA = "id bigint, vec array<double>"


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    centers = 4 * rng.normal(size=(30, 16))
    x = np.concatenate([c + rng.normal(size=(60, 16)) for c in centers])
    x[5::9] = x[4]  # a vector with many copies
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA).cache()


def test_most_neighbours_are_found_at_their_true_distance(points):
    queries = points.where("id % 10 = 0")
    exact = knn_join(queries, points, 5, exclude_self=True)
    found = approximate.approximate_knn_join(queries, points, 5, bucket=60, exclude_self=True).cache()
    row = approximate.recall(found, exact).first()
    assert row["wanted"] == 5 * queries.count() and row["recall"] >= 0.9
    own = {r["id"]: np.array(r["vec"]) for r in points.collect()}
    for r in found.collect():
        assert r["id"] != r["neighbor"]
        assert r["distance"] == pytest.approx(np.linalg.norm(own[r["id"]] - own[r["neighbor"]]))
    ranks = found.groupBy("id").agg(F.max("rank").alias("m"), F.count_distinct("neighbor").alias("n"))
    assert ranks.where("m <> n").isEmpty()


def test_one_bucket_is_the_exact_search(points):
    few = points.where("id < 300")
    exact = knn_join(few, few, 4).orderBy("id", "rank").collect()
    found = approximate.approximate_knn_join(few, few, 4, tables=1, probes=2, bucket=400).orderBy("id", "rank").collect()
    assert [tuple(r) for r in found] == [tuple(r) for r in exact]


def test_more_probes_find_more(points):
    queries = points.where("id % 10 = 3")
    exact = knn_join(queries, points, 5).cache()
    share = [
        approximate.recall(approximate.approximate_knn_join(queries, points, 5, tables=2, probes=p, bucket=30), exact).first()[2]
        for p in (1, 12)
    ]
    assert share[0] < share[1]


def test_probes_lie_across_the_nearest_planes():
    planes = approximate.Planes(np.zeros(6), 3, 5, seed=1)
    sides = planes.sides(np.random.default_rng(2).normal(size=(40, 6)))
    own = planes.codes(sides)
    probed = planes.probes(sides, 4).reshape(40, 3, 4)
    for row, table in np.ndindex(40, 3):
        assert probed[row, table, 0] == own[row, table] and len(set(probed[row, table])) == 4
        first = int(np.argmin(np.abs(sides[row, table])))
        assert own[row, table] ^ (1 << first) in probed[row, table]


def test_points_without_structure_are_searched_exactly(spark):
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 40)))]
    points = spark.createDataFrame(rows, SCHEMA)
    assert approximate.Index(points, 3, tables=1, bucket=2).probes_for(0.9, 3) is None
    found = approximate.approximate_knn_join(points, points, 3, tables=1, bucket=2)
    assert approximate.recall(found, knn_join(points, points, 3)).first()["recall"] == 1.0


def test_empty_sides(spark, points):
    none = spark.createDataFrame([], SCHEMA)
    assert approximate.approximate_knn_join(points, none, 3).isEmpty()
    assert approximate.approximate_knn_join(none, points, 3).isEmpty()
