"""MLlib estimators with the settings of the published runs.

Each entry is a factory ``(n_rows, n_features) -> estimator``. A penalty of
``C = 1`` on a summed loss equals ``regParam = 1/n`` on MLlib's mean loss.
"""

from __future__ import annotations

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)


def logistic_regression(n_rows: int, n_features: int):
    return LogisticRegression(
        regParam=1.0 / n_rows, elasticNetParam=0.0, standardization=False, maxIter=100
    )


def linear_svm(n_rows: int, n_features: int):
    return LinearSVC(regParam=1.0 / n_rows, standardization=False, maxIter=100)


def decision_tree(n_rows: int, n_features: int):
    """Grown until pure; 30 is the deepest tree MLlib builds."""
    return DecisionTreeClassifier(maxDepth=30, maxBins=64, impurity="gini", seed=0)


def mlp(n_rows: int, n_features: int, max_iter: int = 1000):
    """One hidden layer of 100 units."""
    return MultilayerPerceptronClassifier(
        layers=[n_features, 100, 2], maxIter=max_iter, seed=0
    )


def bagging_trees(n_rows: int, n_features: int):
    """Ten full-depth trees on bootstrap samples, all features at each split."""
    return RandomForestClassifier(
        numTrees=10,
        featureSubsetStrategy="all",
        bootstrap=True,
        maxDepth=30,
        maxBins=64,
        seed=0,
    )


def random_forest(n_rows: int, n_features: int):
    return RandomForestClassifier(
        numTrees=10, featureSubsetStrategy="sqrt", maxDepth=30, maxBins=64, seed=0
    )


def gradient_boost_stumps(n_rows: int, n_features: int):
    return GBTClassifier(maxIter=100, stepSize=1.0, maxDepth=1, seed=0)


def gradient_boost_depth2(n_rows: int, n_features: int):
    return GBTClassifier(maxIter=20, stepSize=1.0, maxDepth=2, seed=0)
