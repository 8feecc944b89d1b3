"""Element-wise sums of array columns."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

MAX_COLUMNS = 256


def vector_sums(
    df: DataFrame,
    keys: list[str],
    column: str,
    width: int,
    weight: str | None = None,
    extra: tuple = (),
) -> DataFrame:
    """Per group: ``column`` = sum of the arrays (times ``weight``), then ``extra``.

    Up to MAX_COLUMNS elements each is a plain sum in the hash aggregate. Wider
    arrays go through Summarizer, whose object aggregate sorts once a task meets
    many groups. Either way partial sums precede the shuffle.
    """
    factor = F.col(weight) if weight else F.lit(1.0)
    if width <= MAX_COLUMNS:
        sums = [F.sum(F.get(column, F.lit(i)) * factor).alias(f"_s{i}") for i in range(width)]
        grouped = df.groupBy(*keys).agg(*sums, *extra)
        packed = F.array(*[F.col(f"_s{i}") for i in range(width)]).alias(column)
        return grouped.select(*keys, packed, *grouped.columns[len(keys) + width :])
    total = Summarizer.metrics("sum").summary(array_to_vector(column), factor).alias("_s")
    grouped = df.groupBy(*keys).agg(total, *extra)
    packed = vector_to_array(F.col("_s.sum")).alias(column)
    return grouped.select(*keys, packed, *grouped.columns[len(keys) + 1 :])
