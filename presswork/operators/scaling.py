"""Feature scaling; statistics come from the training folds only."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, MinMaxScaler, StandardScaler, VectorSlicer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F


def as_vector(df: DataFrame, column: str = "features") -> DataFrame:
    """Array column to ML vector."""
    return df.withColumn(column, array_to_vector(F.col(column).cast("array<double>")))


def standard_scaler(train: DataFrame, column: str = "features") -> PipelineModel:
    """Zero mean and unit *population* deviation; constant columns become 0.

    MLlib divides by the sample deviation, hence the constant factor after it.
    """
    n = train.count()
    size = len(train.select(column).first()[0])
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    stages = [
        StandardScaler(inputCol=column, outputCol="_std", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="_std", outputCol="scaled", scalingVec=Vectors.dense([factor] * size)
        ),
    ]
    return Pipeline(stages=stages).fit(train)


def standard_scale(df: DataFrame, test_fold: int, column: str = "features") -> DataFrame:
    model = standard_scaler(df.where(F.col("fold") != test_fold), column)
    return model.transform(df).drop("_std", column).withColumnRenamed("scaled", column)


def minmax_scale(df: DataFrame, column: str = "features") -> DataFrame:
    """Each dimension to [0, 1]."""
    model = MinMaxScaler(inputCol=column, outputCol="scaled").fit(df)
    return model.transform(df).drop(column).withColumnRenamed("scaled", column)


def first_dims(df: DataFrame, k: int = 2, column: str = "features") -> DataFrame:
    sliced = VectorSlicer(inputCol=column, outputCol="sliced", indices=list(range(k)))
    return sliced.transform(df).drop(column).withColumnRenamed("sliced", column)


def feature_stats(df: DataFrame, column: str = "features") -> DataFrame:
    """Mean, minimum and maximum of every dimension in one pass."""
    stats = Summarizer.metrics("mean", "min", "max").summary(F.col(column))
    return df.select(stats.alias("s")).select("s.*")
