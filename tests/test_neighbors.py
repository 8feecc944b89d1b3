import numpy as np
import pytest

from presswork.clustering.dbscan import dbscan
from presswork.clustering.graph import connected_components
from presswork.operators import neighbors


@pytest.fixture
def small_blocks(monkeypatch):
    """Force every cell into several blocks."""
    monkeypatch.setattr(neighbors.block_join, "__defaults__", (16,))


def table(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame(
        [(int(i), [float(v) for v in row]) for i, row in zip(ids, x)], "id bigint, vec array<double>"
    )


def brute(q, q_ids, p, p_ids, k, skip_self=False):
    out = {}
    for i, row in zip(q_ids, q):
        d = np.sqrt(((p - row) ** 2).sum(1))
        order = sorted((d[j], p_ids[j]) for j in range(len(p)) if not (skip_self and p_ids[j] == i))
        out[i] = [n for _, n in order[:k]]
    return out


def lists(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append(r["neighbor"])
    return got


def test_knn_equals_brute_force(spark, small_blocks):
    rng = np.random.default_rng(1)
    p, q = rng.normal(size=(400, 6)), rng.normal(size=(60, 6))
    got = lists(neighbors.knn_join(table(spark, q), table(spark, p), 5))
    assert got == brute(q, range(60), p, range(400), 5)


def test_knn_with_a_third_of_copies(spark, small_blocks):
    """One vector holds a third of all rows on both sides."""
    rng = np.random.default_rng(2)
    p = np.concatenate([np.tile([1.0, 2.0, 3.0], (150, 1)), rng.normal(size=(300, 3))])
    q = np.concatenate([np.tile([1.0, 2.0, 3.0], (40, 1)), rng.normal(size=(80, 3))])
    got = lists(neighbors.knn_join(table(spark, q), table(spark, p), 4))
    assert got == brute(q, range(120), p, range(450), 4)


def test_knn_without_self_and_with_few_points(spark):
    x = np.array([[0.0], [0.0], [1.0]])
    t = table(spark, x)
    got = lists(neighbors.knn_join(t, t, 5, exclude_self=True))
    assert got == brute(x, range(3), x, range(3), 5, skip_self=True)


def test_knn_plan_has_no_cross_join(spark):
    x = table(spark, np.random.default_rng(0).normal(size=(50, 2)))
    plan = neighbors.knn_join(x, x, 3)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_copies_are_limited_before_the_shuffle(spark):
    x = table(spark, np.ones((50, 2)))
    plan = neighbors.first_of_equal(x, 3)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def brute_dbscan(x, eps, m):
    inside = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) <= eps
    core = inside.sum(1) >= m
    label = np.full(len(x), -1)
    c = 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            stack, label[i] = [i], c
            while stack:
                for j in np.flatnonzero(inside[stack.pop()]):
                    if label[j] < 0:
                        label[j] = c
                        if core[j]:
                            stack.append(j)
            c += 1
    return label


def test_dbscan_equals_brute_force(spark, small_blocks):
    rng = np.random.default_rng(3)
    centers = rng.uniform(0, 10, size=(5, 2))
    x = np.concatenate(
        [c + 0.3 * rng.normal(size=(40, 2)) for c in centers]
        + [rng.uniform(0, 10, size=(40, 2)), np.tile(centers[0], (100, 1))]
    )
    got = {r["id"]: r["cluster"] for r in dbscan(table(spark, x), 0.4, 4).collect()}
    assert [got[i] for i in range(len(x))] == list(brute_dbscan(x, 0.4, 4))


def test_dbscan_all_noise(spark):
    x = np.arange(5, dtype=float)[:, None] * 10
    assert {r["cluster"] for r in dbscan(table(spark, x), 0.5, 2).collect()} == {-1}


def test_components_of_a_chain_and_a_star(spark):
    vertices = spark.range(60).toDF("id")
    chain = [(i, i + 1) for i in range(0, 29)]
    star = [(59, i) for i in range(40, 59)]
    edges = spark.createDataFrame(chain + star, "src bigint, dst bigint")
    got = {r["id"]: r["component"] for r in connected_components(vertices, edges).collect()}
    assert all(got[i] == 0 for i in range(30))
    assert all(got[i] == i for i in range(30, 40))
    assert all(got[i] == 40 for i in range(40, 60))


def test_queries_that_meet_every_cell_go_to_groups(spark, monkeypatch):
    """In many dimensions each row was copied to every cell, so copies grew with the square root of the rows."""
    monkeypatch.setattr(neighbors, "MEETINGS", 3)
    monkeypatch.setattr(neighbors, "BLOCK", 100)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 24))
    points = table(spark, x)
    pivots = neighbors.choose_pivots(points, len(x))
    assigned = neighbors.assign_cells(points, pivots)
    cells = neighbors.summarise(assigned, pivots, 6)
    left, right, size = neighbors.meetings(points, assigned.select("id", "vec", "cell"), cells, k=6)
    assert size == {"block": 250} and right.select("cell").distinct().count() <= 6
    assert left.count() <= 6 * len(x) and right.count() == len(x)
    got = lists(neighbors.knn_join(points, points, 5, exclude_self=True))
    assert got == brute(x, range(600), x, range(600), 5, skip_self=True)


def test_dbscan_in_groups_and_runs(spark, monkeypatch):
    """Clusters cut by groups, by blocks and by runs of rows stay whole; with noise and border points."""
    from presswork.clustering import dbscan as module

    rng = np.random.default_rng(4)
    walk = np.cumsum(rng.normal(scale=0.2, size=(300, 12)), axis=0)
    x = np.concatenate([walk, walk + 50.0, rng.uniform(100, 900, size=(20, 12))])
    plain = {r["id"]: r["cluster"] for r in dbscan(table(spark, x), 0.9, 4).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= 0.9
    core = d.sum(1) >= 4
    root = np.where(core, np.arange(len(x)), len(x))
    while True:
        new = np.where(core, np.where(d & core[None], root[None], len(x)).min(1), len(x))
        if (new == root).all():
            break
        root = new
    near = np.where(d & core[None], root[None], len(x)).min(1)
    names = sorted(set(root[core]))
    want = {i: names.index(near[i]) if near[i] < len(x) else -1 for i in range(len(x))}
    assert plain == want and len(names) > 1
    for target, name, value in (
        (neighbors, "MEETINGS", 1), (neighbors, "BLOCK", 64), (module, "CHUNK_PAIRS", 512),
    ):
        monkeypatch.setattr(target, name, value)
    assert {r["id"]: r["cluster"] for r in dbscan(table(spark, x), 0.9, 4).collect()} == want
