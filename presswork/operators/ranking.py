"""Dense positions over a sorted table without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from presswork.session import materialize


def dense_index(df: DataFrame, order: list, name: str) -> DataFrame:
    """Add ``name``: the 0-based position of each row in the global ``order``.

    Range-partition and sort, note each row's place in its partition, and add
    the sizes of the partitions before it. Only one row per partition takes
    part in the running sum; that table is the broadcast side.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    part = F.spark_partition_id()
    placed = ranged.withColumn("_part", part).withColumn(
        "_place",
        F.monotonically_increasing_id() - F.shiftleft(part.cast("bigint"), 33),
    )
    stored = materialize(placed, name)
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"))
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_place") + F.col("_off")).cast("int"))
        .drop("_part", "_place", "_off")
    )
