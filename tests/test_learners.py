import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from presswork.learners import estimators
from presswork.learners.bayes import gaussian_nb
from presswork.learners.boosting import adaboost
from presswork.learners.discriminant import linear_discriminant
from presswork.learners.knn import bagging_knn, knn
from presswork.learners.moments import class_moments, gram
from presswork.learners.relevance import binary_relevance, compare_classifiers
from presswork.operators.metrics import classification_report
from presswork.operators.scaling import standard_scale

NAMES = ["left", "up"]


@pytest.fixture(scope="module")
def separable(spark):
    """Two labels, each decided by one of four features with a clear gap."""
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, size=(300, 4))
    x[:, :2] += np.where(x[:, :2] > 0, 0.5, -0.5)
    rows = []
    for i, v in enumerate(x):
        cats = [n for n, on in zip(NAMES, (v[0] < 0, v[1] > 0)) if on] + ["unused"]
        rows.append((i, i % 5, [float(a) for a in v], cats))
    df = spark.createDataFrame(rows, "doc_id bigint, fold int, features array<double>, categories array<string>")
    return df.withColumn("features", array_to_vector("features")).cache()


def f1(predictions):
    return classification_report(predictions).where("category_idx = -1").first()["f1"]


@pytest.mark.parametrize(
    "make",
    [
        estimators.logistic_regression,
        estimators.linear_svm,
        estimators.decision_tree,
        estimators.mlp,
        estimators.bagging_trees,
        estimators.random_forest,
        estimators.gradient_boost_depth2,
    ],
)
def test_mllib_learners_on_separable_data(separable, make):
    out = binary_relevance(make, separable, NAMES, 2)
    assert out.count() == 120
    assert f1(out) >= 0.9


@pytest.mark.parametrize("learner", [gaussian_nb, linear_discriminant, knn])
def test_closed_forms_on_separable_data(separable, learner):
    out = learner(separable, NAMES, 2)
    assert out.count() == 120
    assert f1(out) >= 0.9


def test_adaboost(separable):
    assert f1(adaboost(separable, NAMES, 2, rounds=5)) >= 0.9


def test_bagging_knn(separable):
    out = bagging_knn(separable, NAMES, 2, members=3, max_features=3)
    assert out.count() == 120 and f1(out) >= 0.8


def test_knn_of_one_returns_own_label(separable):
    out = knn(separable, NAMES, None, k=1)
    assert f1(out) == 1.0


def as_numpy(df):
    rows = df.orderBy("doc_id").collect()
    return np.array([r["features"].toArray() for r in rows]), [r["categories"] for r in rows]


def test_moments_match_numpy(separable):
    x, cats = as_numpy(separable)
    m = class_moments(separable, [*NAMES, "absent"])
    pos = np.array(["left" in c for c in cats])
    assert m.n == len(x) and m.n1[0] == pos.sum() and m.n1[2] == 0
    np.testing.assert_allclose(m.mean1[0], x[pos].mean(0))
    np.testing.assert_allclose(m.mean0[0], x[~pos].mean(0))
    np.testing.assert_allclose(m.square0[0], ((x[~pos] - x[~pos].mean(0)) ** 2).sum(0), rtol=1e-9)
    np.testing.assert_allclose(gram(separable), x.T @ x)


def test_discriminant_matches_numpy(separable):
    x, cats = as_numpy(separable)
    y = np.array(["left" in c for c in cats])
    m1, m0 = x[y].mean(0), x[~y].mean(0)
    within = ((x[y] - m1).T @ (x[y] - m1) + (x[~y] - m0).T @ (x[~y] - m0)) / (len(x) - 2)
    w = np.linalg.solve(within, m1 - m0)
    expected = x @ w - (m1 + m0) @ w / 2 + np.log(y.sum() / (~y).sum())
    got = linear_discriminant(separable, NAMES[:1], None).orderBy("doc_id").collect()
    np.testing.assert_allclose([r["score"] for r in got], expected, rtol=1e-8)


def test_category_without_positives_is_never_predicted(separable):
    for learner in (gaussian_nb, linear_discriminant):
        out = learner(separable, ["absent"], 2)
        assert out.agg(F.sum("prediction")).first()[0] == 0


def test_standard_scale_uses_training_folds(separable):
    scaled = standard_scale(separable, 2).where("fold <> 2")
    x, _ = as_numpy(scaled)
    np.testing.assert_allclose(x.mean(0), 0, atol=1e-12)
    np.testing.assert_allclose(x.std(0), 1)


def test_compare_classifiers(separable):
    out = compare_classifiers({"a": gaussian_nb, "b": linear_discriminant}, separable, NAMES, 2)
    assert out.count() == 6
    assert {r["model"] for r in out.collect()} == {"a", "b"}


def test_logistic_regression_minimises_the_summed_loss(separable):
    """The gradient of sum(log loss) + |w|^2 / 2 vanishes; the intercept is free."""
    x, cats = as_numpy(separable)
    y = np.array(["left" in c for c in cats], dtype=float)
    labelled = separable.select(
        "features", F.array_contains("categories", "left").cast("double").alias("label")
    )
    model = estimators.logistic_regression(len(x), 4).fit(labelled)
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    np.testing.assert_allclose(x.T @ (p - y) + w, 0, atol=0.01)
    np.testing.assert_allclose((p - y).sum(), 0, atol=0.01)
