from functools import partial

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from presswork.learners import estimators, joint_mlp
from presswork.learners.relevance import binary_relevance
from presswork.plans.learn_queries import LEARNERS

NAMES = ["a", "b", "none"]


@pytest.fixture(scope="module")
def rows(spark):
    """Five features; two noisy categories and one that no row carries."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(420, 5))
    noise = rng.normal(size=(420, 2)) / 3
    made = []
    for i, v in enumerate(x):
        cats = [n for n, on in zip(NAMES, (v[0] * v[1] + noise[i, 0] > 0, v[2] + noise[i, 1] > 0.5)) if on]
        made.append((i, i % 5, [float(a) for a in v], cats))
    df = spark.createDataFrame(made, "doc_id bigint, fold int, features array<double>, categories array<string>")
    return df.withColumn("features", array_to_vector("features")).repartition(2, "doc_id").cache()


def by_key(df):
    return df.toPandas().sort_values(["doc_id", "category_idx"]).reset_index(drop=True)


@pytest.mark.parametrize(("steps", "near"), [(0, 1e-12), (5, 1e-9), (40, 1e-4)])
def test_scores_equal_those_of_mllib_fits(rows, steps, near):
    one_by_one = by_key(binary_relevance(partial(estimators.mlp, max_iter=steps), rows, NAMES))
    joint = by_key(joint_mlp.mlp(rows, NAMES, max_iter=steps))
    assert list(joint.columns) == list(one_by_one.columns)
    assert np.allclose(joint["score"], one_by_one["score"], rtol=0, atol=near)
    assert (joint[["doc_id", "category_idx", "label"]] == one_by_one[["doc_id", "category_idx", "label"]]).all(None)


def test_one_gradient_job_serves_all_categories(rows):
    train = rows.where("fold <> 2")
    alone = [joint_mlp.joint_weights(train, [n], 40)[2] for n in NAMES]
    weights, _, jobs = joint_mlp.joint_weights(train, NAMES, 40)
    assert len(weights) == len(NAMES)
    # Rounding may add or save a step; one job a category and step would be the sum.
    assert jobs <= 1.3 * max(alone) < sum(alone)


def test_registered_perceptron_is_the_joint_one():
    assert LEARNERS["mlp"] is joint_mlp.mlp


def test_null_labels_are_refused(spark, rows):
    broken = rows.selectExpr("doc_id", "fold", "features", "array(string(null)) AS categories")
    with pytest.raises(Exception, match="labels must not be null"):
        joint_mlp.mlp(broken, NAMES, max_iter=1)


def test_a_vanished_probability_makes_the_loss_no_number():
    class Shared:
        value = np.array([[0.0, 0.0, 0.0, 0.0, -500.0, 500.0]]), [0]

    block = np.ones(1).tobytes(), np.ones(1, np.uint8).tobytes()
    (found,) = joint_mlp.partial(Shared, 1, 1, 1)([block])
    assert np.isnan(found[0, -1])
