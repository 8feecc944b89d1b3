"""Streams of documents: running word counts, naive Bayes sums and PCA sketches.

Each operator has a pure transformation, equal to its batch form once the input
is consumed, and a ``run_*`` helper that drives it over all available input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from presswork.operators import bags
from presswork.operators.reduce import fold_sketches, merge_sketches
from presswork.operators.vectors import MAX_COLUMNS
from presswork.session import materialize, scratch_path


def unique_docs(stream: DataFrame, key: str = "doc_id") -> DataFrame:
    """Drop replayed documents. State grows with the ids unless a watermark is set."""
    return stream.dropDuplicates([key])


def stream_word_counts(stream: DataFrame, text: str = "full_text", **bag_options) -> DataFrame:
    """Document and collection frequency per term, updated as documents arrive.

    Bags are built inside the row, so the only state is one pair of counters
    per term.
    """
    wide = bags.wide_bags(stream, text=text, **bag_options)
    return bags.word_dictionary(bags.long_bags(wide))


def stream_multinomial_nb(stream: DataFrame, names: list[str]) -> DataFrame:
    """Running weight per (category, label, term) over the fixed labels 0 and 1.

    The stream has ``categories`` and parallel arrays ``indices`` and
    ``weights``. State: one sum per category, label and term seen.
    """
    entries = F.arrays_zip(F.col("indices").alias("term_idx"), F.col("weights").alias("weight"))
    labels = [F.array_contains("categories", n).cast("int") for n in names]
    rows = stream.select(F.explode(entries).alias("e"), F.array(*labels).alias("y"))
    # A sum for each category and label, so that an entry is one row; null where no entry had that label.
    kinds = [(i, label) for i in range(len(names)) for label in (0, 1, None)]
    if len(kinds) <= MAX_COLUMNS:
        sums = [
            F.sum(F.when(F.get("y", F.lit(i)).eqNullSafe(F.lit(label)), F.col("e.weight"))).alias(f"_s{k}")
            for k, (i, label) in enumerate(kinds)
        ]
        lines = [
            F.struct(F.lit(i).alias("category_idx"), F.lit(label).cast("int").alias("label"), F.col(f"_s{k}").alias("weight"))
            for k, (i, label) in enumerate(kinds)
        ]
        flat = rows.groupBy(F.col("e.term_idx").alias("term_idx")).agg(*sums).select("term_idx", F.inline(F.array(*lines)))
        return flat.where("weight is not null").select("category_idx", "label", "term_idx", "weight")
    return (
        rows.select("e.term_idx", "e.weight", F.posexplode("y").alias("category_idx", "label"))
        .groupBy("category_idx", "label", "term_idx")
        .agg(F.sum("weight").alias("weight"))
    )


def _batch_path(folder: str, batch_id: int) -> str:
    return f"{folder}/stream_batch={batch_id}"


def _last_batch(spark: SparkSession, folder: str) -> int | None:
    """The latest batch with rows in ``folder``, as the shared folder tells, also after a restart."""
    spark.range(0).write.mode("ignore").parquet(_batch_path(folder, -1))
    found = spark.read.schema("stream_batch long").parquet(folder)
    return found.agg(F.max("stream_batch")).first()[0]


def run_to_table(result: DataFrame, mode: str = "complete", folder: str | None = None) -> DataFrame:
    """Drive an aggregating stream over all available input; return its last state.

    Every batch writes its complete result to a folder of its own, so a replayed
    batch overwrites itself and nothing passes through the driver. With the
    ``folder`` of an earlier run the stream goes on where that one ended.
    """
    spark = result.sparkSession
    base = folder or scratch_path(spark, "stream")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_path(f"{base}/out", batch_id))

    query = (
        result.writeStream.outputMode(mode)
        .foreachBatch(keep)
        .option("checkpointLocation", f"{base}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    last = _last_batch(spark, f"{base}/out")
    if last is None:
        return spark.createDataFrame([], result.schema)
    return spark.read.schema(result.schema).parquet(_batch_path(f"{base}/out", last))


def run_stream_multinomial_nb(stream: DataFrame, names: list[str], folder: str | None = None) -> DataFrame:
    """``stream_multinomial_nb`` over all available input.

    Each micro-batch writes its own sums under its own number, so a replay overwrites it, and no
    batch holds or writes again what earlier ones left; they are added up once. With the
    ``folder`` of an earlier run the stream goes on where that one ended.
    """
    spark = stream.sparkSession
    base = folder or scratch_path(spark, "stream-nb")

    def keep(batch: DataFrame, batch_id: int) -> None:
        stream_multinomial_nb(batch, names).write.mode("overwrite").parquet(_batch_path(f"{base}/out", batch_id))

    query = (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", f"{base}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = "category_idx int, label int, term_idx int, weight double"
    if _last_batch(spark, f"{base}/out") is None:
        return spark.createDataFrame([], schema)
    parts = spark.read.schema(f"{schema}, stream_batch long").parquet(f"{base}/out")
    return parts.groupBy("category_idx", "label", "term_idx").agg(F.sum("weight").alias("weight"))


def run_stream_pca(stream: DataFrame, d: int, k: int, seed: int = 0, folder: str | None = None) -> DataFrame:
    """Merged PCA sketch of a stream of sparse rows.

    Each micro-batch writes its own sketch under its own number, so a replay
    overwrites it, and no batch moves what earlier ones left; sums make their order
    irrelevant. With the ``folder`` of an earlier run the stream goes on where that
    one ended. The result feeds ``components_of``.
    """
    spark = stream.sparkSession
    base = folder or scratch_path(spark, "stream-pca")

    def merge(batch: DataFrame, batch_id: int) -> None:
        sketch = fold_sketches(batch.withColumn("fold", F.lit(0)), d, k, seed).select("term_idx", "v")
        sketch.write.mode("overwrite").parquet(_batch_path(f"{base}/state", batch_id))

    query = (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{base}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if _last_batch(spark, f"{base}/state") is None:
        return spark.createDataFrame([], "term_idx int, v array<double>")
    schema = "term_idx int, v array<double>, stream_batch long"
    return materialize(merge_sketches(spark.read.schema(schema).parquet(f"{base}/state")), "sketch")
