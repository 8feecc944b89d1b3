"""Stage tables on disk, and reproducible peeks at them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from presswork.functions.maths import hash_key
from presswork.session import scalar


def write_stage(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Parquet, one folder per fold where ``partition_by`` names the fold column."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def read_stage(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    return reader.parquet(path)


def write_stage_table(df: DataFrame, table: str, buckets: int, key: str = "doc_id") -> None:
    """A bucketed table: joins and groupings on ``key`` then need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def doc_count(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count("*").alias("n_docs"))


def sample_docs(df: DataFrame, n: int, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """``n`` documents in a reproducible random order."""
    return _lowest(df, hash_key(F.col(key), seed), n)


def limit_docs(df: DataFrame, n: int = 100000, key: str = "doc_id") -> DataFrame:
    """The first ``n`` documents by id."""
    return _lowest(df, F.col(key), n)


def _lowest(df: DataFrame, order: Column, n: int) -> DataFrame:
    """Rows up to the n-th smallest key; only keys, never rows, meet in one task."""
    keys = df.select(order.alias("k")).orderBy("k").limit(n)
    return df.where(order <= scalar(keys, F.max("k")))
