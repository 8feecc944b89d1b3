"""Mix sources to target weights by Efraimidis-Spirakis sampling.

Each document draws the key ``-ln(u) / w``: ``u`` from an md5 of its id, ``w`` its
quality weight. Within a source documents are taken in ascending order of keys
until the source's budget of words is met. Budgets beyond the source's size are
whole epochs (every document once more) before the fractional part is drawn.

The prefix sums never gather a source in one task: keys fall into buckets whose
number follows the table, one row per bucket is summed up, and only the bucket in
which a budget ends is ranked document by document. What comes out is one cut per
source, so the verdict on a document needs the document and its source's cut alone.

Defined cases: a null text has size 0 and is never taken; null sources form one
source that comes last; a null doc_id hashes like an empty one and sorts first;
rows that agree in id and size are taken or left together; equal keys go by id,
then size; an empty table gives an empty result. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from presswork.functions.maths import hash_key
from presswork.llm.common import word_count
from presswork.session import materialize

MAX_EPOCHS = 3
SEED = "mix"
BUCKET_ROWS = 4096
# Letters a word is expected to have: documents far from it (tables, runs of symbols) weigh less.
USUAL_WORD = 6.0


def quality_weight(text: Column, size: Column) -> Column:
    """Between 0 and 1: how near the mean word length, blanks included, is to the usual one."""
    mean = F.length(text) / size
    near = F.least(mean / USUAL_WORD, USUAL_WORD / mean)
    return F.when(size > 0, F.greatest(near, F.lit(1e-3))).otherwise(F.lit(1.0))


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    digits = F.substring(hash_key(F.coalesce(doc_id.cast("string"), F.lit("")), seed), 1, 13)
    unit = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(2.0**52)
    return -F.log(unit) / weight


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``.

    Sources by code point, null last, weigh ``weights`` in turn. A target stops at
    ``MAX_EPOCHS`` times its source's size; the excess is shared out again by
    weight. With sources in order of size per weight, those before the first one
    that holds its share of what is left are the capped ones. One row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    per = per.withColumn("weight", F.get(cycle, place % len(weights)))
    per = per.withColumn("cap", F.col("source_size") * MAX_EPOCHS)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left_size = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    left_weight = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    per = per.withColumn("share", left_size / left_weight)
    holds = F.col("cap") / F.col("weight") >= F.col("share")
    rank = F.row_number().over(order)
    per = per.withColumn("first", F.when(holds, F.struct(rank.alias("r"), F.col("share").alias("s"))))
    level = F.min("first").over(all_rows)["s"]
    target = F.least(F.col("cap").cast("double"), level * F.col("weight"))
    return per.select(
        "source", "source_size", F.coalesce(target, F.col("cap").cast("double")).alias("target")
    )


def _bucket(key: Column, n: Column) -> Column:
    """Ascending in ``key``; even if weights are near 1, else at least never out of order."""
    return F.least(n - 1, F.floor(n * (1 - F.exp(-key)))).cast("long")


def source_cuts(sized: DataFrame) -> DataFrame:
    """``(source, source_size, target, epochs, n_buckets, cut_bucket, cut)`` per source.

    ``sized`` has ``doc_id, source, size, key``. A document is drawn if half of it
    fits the budget that documents with smaller keys leave.
    """
    plan = materialize(source_targets(sized.select("source", "size")), "mix-targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("epochs", epochs.cast("long"))
    plan = plan.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    n = F.greatest(F.lit(1), F.ceil(F.lit(sized.count() / BUCKET_ROWS))).cast("long")
    sized = sized.withColumn("bucket", _bucket(F.col("key"), n))
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    same = F.col("p.source").eqNullSafe(F.col("s.source"))
    ends = plan.alias("p").join(sums.alias("s"), same & (F.col("before") + F.col("words") > F.col("budget")))
    ends = ends.groupBy(F.col("p.source").alias("source")).agg(
        F.min(F.struct("bucket", "before", "budget")).alias("end")
    )
    ends = materialize(ends.select("source", "end.*"), "mix-ends")
    edge = sized.alias("d").join(
        ends.alias("e"),
        F.col("d.source").eqNullSafe(F.col("e.source")) & (F.col("d.bucket") == F.col("e.bucket")),
    )
    edge = edge.select("d.source", "d.size", "before", "budget", F.struct("key", "doc_id", "size").alias("at"))
    upto = Window.partitionBy("source").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("before") + F.coalesce(F.sum("size").over(upto), F.lit(0)) + F.col("size") / 2
    drawn = edge.withColumn("middle", middle).where("middle <= budget")
    cuts = drawn.groupBy("source").agg(F.max("at").alias("cut"))
    joined = (
        plan.alias("p")
        .join(ends.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left")
        .join(cuts.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
    )
    return joined.select(
        "p.source", "source_size", "target", "epochs", n.alias("n_buckets"),
        F.col("bucket").alias("cut_bucket"), "cut",
    )


def mix(docs: DataFrame, text: str = "text", out: str = "mix", seed: str = SEED) -> DataFrame:
    """Add a struct ``out``: size, source_size, target, copies and taken words per document."""
    size = word_count(F.col(text))
    sized = docs.select(
        F.col("doc_id"), F.col("source"), size.alias("size"), F.length(text).alias("chars"),
        quality_weight(F.col(text), size).alias("weight"),
    )
    sized = sized.withColumn("key", sampling_key(F.col("doc_id"), F.col("weight"), seed))
    sized = materialize(sized.select("doc_id", "source", "size", "key"), "mix-sized")
    cuts = materialize(source_cuts(sized), "mix-cuts")
    # One struct, so that no column of the documents can share a name with it.
    cuts = cuts.select(F.col("source").alias("__m_source"), F.struct(*cuts.columns).alias("__m"))
    joined = docs.withColumn("__m_size", size).join(
        cuts, F.col("source").eqNullSafe(F.col("__m_source")), "left"
    )
    key = sampling_key(F.col("doc_id"), quality_weight(F.col(text), F.col("__m_size")), seed)
    joined = joined.withColumn("__m_key", key)
    bucket = _bucket(F.col("__m_key"), F.col("__m.n_buckets"))
    at = F.struct(F.col("__m_key").alias("key"), F.col("doc_id"), F.col("__m_size").alias("size"))
    drawn = (
        F.when(F.col("__m.cut_bucket").isNull(), F.lit(False))
        .when(bucket < F.col("__m.cut_bucket"), F.lit(True))
        .otherwise((bucket == F.col("__m.cut_bucket")) & F.coalesce(at <= F.col("__m.cut"), F.lit(False)))
    )
    copies = F.when(F.col("__m_size") > 0, F.col("__m.epochs") + drawn.cast("long")).otherwise(F.lit(0))
    result = F.struct(
        F.col("__m_size").alias("size"), F.col("__m.source_size"), F.col("__m.target"),
        copies.cast("long").alias("copies"), (F.col("__m_size") * copies).cast("long").alias("taken"),
    )
    return joined.select(*[F.col(c) for c in docs.columns if c != out], result.alias(out))
