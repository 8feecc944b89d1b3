"""The given Parquet tables in the shapes of the stage tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from presswork.operators.folds import assign_folds
from presswork.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id string, text, lang, source)`` spread over the cores."""
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", "source"
    )
    return spread(rows, "doc_id")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, categories, full_text)``; language and source are the categories."""
    return documents(spark, sf_dir).select(
        "doc_id", F.array("lang", "source").alias("categories"), F.col("text").alias("full_text")
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, categories)`` without texts; judged documents get further labels."""
    base = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    judged = table(spark, sf_dir, "labels")
    joined = base.join(judged, "doc_id", "left")
    extra = F.array(
        F.when(F.col("quality") == 1, F.lit("quality")),
        F.when(F.col("toxic") == 1, F.lit("toxic")),
    )
    names = F.concat(F.array("lang", "source"), F.filter(extra, lambda c: c.isNotNull()))
    return joined.select(F.col("doc_id").cast("string").alias("doc_id"), names.alias("categories"))


def points(spark: SparkSession, sf_dir: str, folds: int = 10) -> DataFrame:
    """``(doc_id bigint, fold, features, categories)`` from the embeddings."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.array(F.concat(F.lit("c"), F.col("label"))).alias("categories"),
    )
    return assign_folds(rows, folds)


def languages(spark: SparkSession, sf_dir: str) -> list[str]:
    """All languages of the documents, in order: a category list, so a short one."""
    found = table(spark, sf_dir, "documents").where("lang is not null").select("lang").distinct()
    return sorted(r["lang"] for r in found.collect())


def point_categories(spark: SparkSession, sf_dir: str) -> list[str]:
    """All categories of the embeddings, in the order of their labels: a category list, so a short one."""
    found = table(spark, sf_dir, "embeddings").where("label is not null").select("label").distinct()
    return [f"c{label}" for label in sorted(r["label"] for r in found.collect())]
