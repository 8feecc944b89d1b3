"""Reproducible folds of equal size, assigned by a projection."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from presswork.functions.maths import hash_key

PREFIX = 3  # hex digits: 4,096 buckets of an even hash


def fold_cuts(docs: DataFrame, k: int = 10, seed: int = 42, key: str = "doc_id") -> list[str]:
    """The hash values at which folds 1..k-1 begin.

    Documents are ranked by hash and cut every ``ceil(n/k)`` ranks. Counts of
    the 4,096 hash prefixes say in which bucket each cut falls; only those
    buckets are ranked. Neither step sorts or moves the whole collection.
    """
    hashes = docs.select(hash_key(F.col(key), seed).alias("h"))
    bucket = F.substring("h", 1, PREFIX)
    counts = hashes.groupBy(bucket.alias("b")).count().collect()
    total = sum(r["count"] for r in counts)
    size = math.ceil(total / k) if total else 1
    wanted = [j * size for j in range(1, k) if j * size < total]
    targets, start = [], 0
    for row in sorted(counts, key=lambda r: r["b"]):
        targets += [(row["b"], t - start + 1) for t in wanted if start <= t < start + row["count"]]
        start += row["count"]
    if not targets:
        return []
    order = W.partitionBy("b").orderBy("h")
    ranked = (
        hashes.withColumn("b", bucket)
        .where(F.col("b").isin([b for b, _ in targets]))
        .withColumn("r", F.row_number().over(order))
    )
    hit = F.lit(False)
    for b, r in targets:
        hit = hit | ((F.col("b") == b) & (F.col("r") == r))
    return sorted(r["h"] for r in ranked.where(hit).select("h").collect())


def fold_number(cuts: list[str], seed: int = 42, key: str = "doc_id") -> Column:
    h = hash_key(F.col(key), seed)
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= h))


def assign_folds(docs: DataFrame, k: int = 10, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """Add ``fold``. All folds have ``ceil(n/k)`` documents but the last ones."""
    return docs.withColumn("fold", fold_number(fold_cuts(docs, k, seed, key), seed, key))


def train_folds(df: DataFrame, test_fold: int) -> DataFrame:
    return df.where(F.col("fold") != test_fold)


def held_out_fold(df: DataFrame, test_fold: int) -> DataFrame:
    return df.where(F.col("fold") == test_fold)


def union_folds(*folds: DataFrame) -> DataFrame:
    """Stack folds that come as separate tables."""
    out = folds[0]
    for fold in folds[1:]:
        out = out.unionByName(fold)
    return out


def attach_labels(features: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Labels and features joined by document instead of by row position."""
    return features.join(labels, key)
