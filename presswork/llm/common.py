"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The white space of all word and line rules here: space and U+0009..U+000D.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_array(text: Column) -> Column:
    """The words of ``text``; null and blank texts give an empty array."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANK_RUN)
    )


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def binaries(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes; null reads as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def chunks(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = 1 << 21
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows of about ``size`` bytes of text.

    A run has at least one row, so a very long text is a run of its own.
    """
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(batch.schema.get_field_index(text)).cast(pa.binary()))
        ends = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def pow2_at_least(n: float) -> int:
    size = 1
    while size < n:
        size *= 2
    return size
