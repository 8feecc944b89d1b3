"""AdaBoost of all categories at once against one category at a time."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from presswork.learners import boosting, joint_boost

NAMES = ["a", "b", "never"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(400):
        x = [float(v) for v in rng.integers(0, 12, size=3)]
        own = [n for n, on in (("a", x[0] + x[1] + rng.normal() > 11), ("b", abs(x[2] - 5) + rng.normal() > 3)) if on]
        rows.append((i, i % 4, x, own))
    df = spark.createDataFrame(rows, "doc_id bigint, fold int, features array<double>, categories array<string>")
    return df.withColumn("features", array_to_vector("features")).cache()


def test_equals_the_stumps_of_single_categories(data):
    got = {(r["doc_id"], r["category_idx"]): r for r in joint_boost.adaboost(data, NAMES, 1, rounds=6).collect()}
    expected = boosting.adaboost(data, NAMES, 1, rounds=6).collect()
    assert len(got) == len(expected) == 100 * len(NAMES)
    for row in expected:
        own = got[row["doc_id"], row["category_idx"]]
        assert own["score"] == pytest.approx(row["score"], abs=1e-6)
        assert (own["label"], own["prediction"]) == (row["label"], row["prediction"])


def test_jobs_follow_rounds_not_categories(data):
    train = data.where("fold <> 1")
    many, _, jobs = joint_boost.boost(train, NAMES, rounds=4)
    assert jobs == 4 and [len(s) for s in many] == [4, 4, 1]
    one, _, jobs = joint_boost.boost(train, NAMES[:1], rounds=4)
    assert jobs == 4 and np.allclose(one[0], many[0])


def test_a_parted_category_stops(spark):
    rows = [(i, 0, [float(i), 1.0], ["low"] if i < 20 else []) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, fold int, features array<double>, categories array<string>")
    df = df.withColumn("features", array_to_vector("features"))
    found = joint_boost.adaboost(df, ["low"], None)
    assert found.where("prediction = label").count() == 50
    assert joint_boost.boost(df, ["low"])[2] == 1
