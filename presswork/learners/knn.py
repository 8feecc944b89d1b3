"""k nearest neighbours and bagged nearest neighbours."""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from presswork.functions.maths import hash_key, hash_unit, poisson_draw
from presswork.learners.relevance import split
from presswork.operators.categories import indicator
from presswork.operators.neighbors import knn_join, points_of, top_k
from presswork.operators.vectors import vector_sums
from presswork.session import materialize


def knn(data: DataFrame, names: list[str], test_fold: int | None = 2, k: int = 5) -> DataFrame:
    """Majority vote of the k nearest training rows; score = share of votes."""
    train, test = split(data, test_fold)
    near = knn_join(points_of(test), points_of(train), k)
    return _vote(near, train, test, names)


def _vote(near: DataFrame, train: DataFrame, test: DataFrame, names: list[str]) -> DataFrame:
    """Average the neighbours' label arrays, element by element."""
    labels = train.select(F.col("doc_id").alias("neighbor"), indicator(names).alias("y"))
    votes = vector_sums(
        near.join(labels, "neighbor"), ["id"], "y", len(names), extra=(F.count("*").alias("n"),)
    )
    scored = votes.select(
        F.col("id").alias("doc_id"), F.transform("y", lambda v: v / F.col("n")).alias("s")
    )
    zipped = F.arrays_zip(indicator(names).alias("label"), F.col("s").alias("score"))
    return test.join(scored, "doc_id").select(
        "doc_id", F.posexplode(zipped).alias("category_idx", "l")
    ).select(
        "doc_id",
        "category_idx",
        F.col("l.label").alias("label"),
        F.col("l.score").alias("score"),
        (F.col("l.score") > 0.5).cast("double").alias("prediction"),
    )


def feature_draw(member: int, n_features: int, size: int, seed: int = 42) -> list[int]:
    """The features of one member: the ``size`` lowest hashes, without replacement."""

    def key(i: int) -> str:
        return hashlib.md5(f"feature:{member}:{i}:{seed}".encode()).hexdigest()

    return sorted(sorted(range(n_features), key=key)[:size])


def bagging_knn(
    data: DataFrame,
    names: list[str],
    test_fold: int | None = 2,
    members: int = 10,
    k: int = 5,
    max_features: int = 10,
    seed: int = 42,
    parallelism: int = 8,
) -> DataFrame:
    """Mean vote of members that see resampled rows and ten features each.

    A row's bootstrap multiplicity is a Poisson(1) draw from its hash. Copies
    of a row take several of the k places, so the search keeps the k nearest
    distinct rows and the copies are laid out afterwards.
    """
    train, test = split(data, test_fold)
    n_features = len(data.select("features").first()[0])

    def member_votes(member: int) -> DataFrame:
        chosen = feature_draw(member, n_features, min(max_features, n_features), seed)

        def view(df: DataFrame) -> DataFrame:
            x = vector_to_array("features")
            return df.select("doc_id", F.array(*[F.get(x, F.lit(i)) for i in chosen]).alias("x"))

        drawn = poisson_draw(hash_unit("row", member, F.col("doc_id"), seed))
        sampled = train.withColumn("copies", drawn).where(F.col("copies") > 0)
        near = knn_join(points_of(view(test), "x"), points_of(view(sampled), "x"), k)
        copies = sampled.select(F.col("doc_id").alias("neighbor"), "copies")
        repeated = near.join(copies, "neighbor").select(
            "id",
            "neighbor",
            "distance",
            F.explode(F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(k)))).alias("copy"),
        )
        return materialize(_vote(top_k(repeated, k), train, test, names), "votes")

    # Members are independent; a few driver threads keep the cluster busy.
    with ThreadPoolExecutor(min(parallelism, members)) as pool:
        shares = list(pool.map(member_votes, range(members)))
    votes = reduce(DataFrame.unionByName, shares)
    mean = F.avg("score")
    return votes.groupBy("doc_id", "category_idx").agg(
        F.max("label").alias("label"), mean.alias("score")
    ).withColumn("prediction", (F.col("score") > 0.5).cast("double"))
