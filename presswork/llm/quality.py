"""Quality rules: word statistics and a hashed n-gram log-likelihood ratio.

Everything is a DataFrame expression. A text is one row throughout: its words,
their hashes and its windows are arrays inside the row, so scoring moves no
text. The only exchanges are bucket counts and the held-out ratios of judged documents.

The verdict uses ``held_out_ratio``: texts are dealt into ``FOLDS`` folds by their hash
(exact copies together) and each is scored with counts of the other folds alone, on the
trusted and on the raw side, so trusted and other texts are judged alike. Its threshold is
the highest that keeps ``RECALL`` of all judged good documents. ``log_ratio`` is the plain
ratio over all counts, trusted texts with their own included. The number of buckets follows
the counted volume of the trusted texts.

Texts are read twice: once for the counts, once for statistics and ratios, which are written;
the threshold and the verdict come from that table. The weights are a table as well and reach
the tasks as the value of a scalar subquery, so neither the plan nor Python on the driver holds them.

Defined cases: a null or blank text has no words, counts of zero and fails the
base rule; rows are judged one by one, so repeated rows get equal verdicts; a very long text is
one row and judged whole; a null doc_id is scored and never trusted; an empty table gives an
empty result; without a trusted text the ratios are zero for everyone and only the base rule
decides, as it does without a judged good document of ``MIN_WORDS`` words. Other columns pass
through whatever their names; a column named like ``out`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from presswork.functions.maths import hash_key
from presswork.llm.common import WORD, pow2_at_least, word_array, word_count
from presswork.session import materialize, require_broadcastable, scalar

# Least number of buckets, and how many words and pairs of trusted texts a bucket holds on average.
BUCKETS = 1 << 14
LOAD = 128
TRUSTED = 20_000
FOLDS = 4
# Share of the judged good documents, of MIN_WORDS words or more, that the ratio must keep.
RECALL = 0.98
# Held-out ratios are counted and compared in steps of one part in so many.
STEPS = 10_000
SMOOTHING = 2.0
MIN_WORDS = 50
# Beyond so many repeated windows, they are found by sorting positions instead of by list search.
LISTED = 128


def good_documents(labels: DataFrame) -> DataFrame:
    """Ids of all judged good documents that are not toxic; they set the threshold."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
    return good.select("doc_id").distinct()


def trusted_documents(labels: DataFrame, limit: int = TRUSTED) -> DataFrame:
    """Ids of judged good documents that are not toxic: the target's training texts.

    At most ``limit`` of them, by hash; this bounds what is sent to every task.
    """
    return good_documents(labels).orderBy(hash_key(F.col("doc_id"), "trusted"), "doc_id").limit(limit)


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(hashes: Column, n: Column, width: int = 3) -> Column:
    """Hashes of all windows of ``width`` words, in order, from the words' hashes."""
    firsts = F.slice(hashes, F.lit(1), F.greatest(n - (width - 1), F.lit(0)))
    return F.transform(firsts, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, width)]))


def _repeated_positions(windows: Column, repeated: Column) -> Column:
    """Positions, ascending, of the windows that occur twice or more."""
    none = F.array().cast("array<int>")
    listed = F.filter(
        F.sequence(F.lit(0), F.size(windows) - 1), lambda i: F.array_contains(repeated, F.get(windows, i))
    )
    pairs = F.array(F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    by_sort = F.transform(
        pairs,
        lambda p: F.sort_array(
            F.transform(
                F.filter(
                    p,
                    lambda e, k: (F.coalesce(F.get(p, k - 1)["h"] == e["h"], F.lit(False)))
                    | (F.coalesce(F.get(p, k + 1)["h"] == e["h"], F.lit(False))),
                ),
                lambda e: e["i"],
            )
        ),
    )
    return (
        F.when(F.size(repeated) == 0, none)
        .when(F.size(repeated) <= LISTED, listed)
        .otherwise(F.element_at(by_sort, 1))
    )


def _covered(positions: Column) -> Column:
    """How many words the three-word windows at ``positions`` cover together."""
    steps = F.transform(
        positions, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(positions, k + 1) - p, F.lit(3)))
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base statistics in columns ``__q_*``."""
    body = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumn("__q_words", word_array(F.col(text)))
    step = step.withColumns({"__q_n": F.size("__q_words"), "__q_hashes": _hashes(F.col("__q_words"))})
    step = step.withColumn("__q_windows", _windows(F.col("__q_hashes"), F.col("__q_n")))
    step = step.withColumn(
        "__q_sorted",
        F.when(
            F.size(F.array_distinct("__q_windows")) < F.size("__q_windows"), F.sort_array("__q_windows")
        ).otherwise(F.array().cast("array<bigint>")),
    )
    again = F.filter("__q_sorted", lambda h, i: (i > 0) & (F.get(F.col("__q_sorted"), i - 1) == h))
    step = step.withColumn("__q_repeated", F.array_distinct(again))
    step = step.withColumn(
        "__q_positions", _repeated_positions(F.col("__q_windows"), F.col("__q_repeated"))
    )
    step = step.withColumn("__q_lines", F.filter(F.split(body, "\n"), lambda x: F.regexp_like(x, F.lit(WORD))))
    return step.withColumns(
        {
            "__q_chars": F.length(F.array_join("__q_words", "")).cast("long"),
            "__q_symbols": F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("long"),
            "__q_dup_lines": (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long"),
            "__q_repeats": _covered(F.col("__q_positions")),
        }
    )


def _known(docs: DataFrame, trusted: DataFrame, how: str) -> DataFrame:
    ids = F.broadcast(trusted.select(F.col("doc_id").alias("__t"), F.lit(1).alias("__in")))
    return docs.join(ids, F.col("doc_id") == F.col("__t"), how)


def _fold(text: str) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(FOLDS)).cast("int")


def bucket_count(docs: DataFrame, trusted: DataFrame, text: str = "text") -> int:
    """Buckets for the volume of the trusted texts.

    That volume sets how many can differ: a bucket's weight leaves zero where trusted texts hold
    it or would be expected to, and the expected counts sum up to the trusted volume.
    """
    words = word_count(F.col(text))
    volume = _known(docs.select("doc_id", text), trusted, "inner").agg(F.sum(2 * words)).first()[0] or 0
    return max(BUCKETS, pow2_at_least(volume / LOAD))


def bucket_weights(docs: DataFrame, trusted: DataFrame, text: str, buckets: int) -> DataFrame:
    """``(bucket, weights)``: log ratios of two multinomials over hashed words and word pairs.

    The raw multinomial counts every document, the trusted one those whose ids
    ``trusted`` lists; the raw one is scaled to its size and both are smoothed alike.
    Weight k leaves out fold k on both sides, the last one holds all.
    """
    known = _known(docs.select("doc_id", text), trusted, "left")
    words = known.select(
        F.coalesce("__in", F.lit(0)).alias("good"), _fold(text).alias("fold"), word_array(F.col(text)).alias("w")
    )
    following = F.slice("w", F.lit(2), F.greatest(F.size("w"), F.lit(1))).alias("b")
    pairs = words.select("good", "fold", F.inline(F.arrays_zip(F.col("w").alias("a"), following)))
    second = F.when(F.col("b").isNotNull(), F.xxhash64("b")).alias("b")
    hashed = pairs.select("good", "fold", F.xxhash64("a").alias("a"), second)
    both = F.array(F.col("a"), F.when(F.col("b").isNotNull(), F.xxhash64("a", "b")))
    counts = (
        hashed.select("good", "fold", F.explode(both).alias("h"))
        .where("h is not null")
        .groupBy(F.col("h").bitwiseAND(F.lit(buckets - 1)).alias("bucket"), "fold")
        .agg(F.count("*").alias("raw"), F.sum("good").alias("target"))
    )
    counts = materialize(counts, "bucket-counts")
    folds = range(FOLDS)

    def sums(name: str, prefix: str) -> list[Column]:
        parts = [F.sum(F.when(F.col("fold") != k, F.col(name))) for k in folds] + [F.sum(name)]
        return [F.coalesce(p, F.lit(0)).alias(f"{prefix}{name}{k}") for k, p in enumerate(parts)]

    totals = counts.agg(*sums("raw", "n_"), *sums("target", "n_"))
    each = counts.groupBy("bucket").agg(*sums("raw", ""), *sums("target", ""))
    every = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket"))
    filled = every.join(each, "bucket", "left").crossJoin(F.broadcast(totals))

    def weight(k: int) -> Column:
        # What the trusted texts would hold of a bucket if they were like the corpus. Both sides get
        # the same pseudo-counts, so few trusted texts give weights near zero. Over all counts one
        # occurrence is left out: a judged document brings its own into the corpus.
        others = F.coalesce(f"raw{k}", F.lit(0))
        others = F.greatest(others - 1, F.lit(0)) if k == FOLDS else others
        expected = others * F.col(f"n_target{k}") / F.greatest(F.col(f"n_raw{k}"), F.lit(1))
        ratio = F.log((F.coalesce(f"target{k}", F.lit(0)) + SMOOTHING) / (expected + SMOOTHING))
        return F.when(F.col(f"n_target{k}") > 0, ratio).otherwise(F.lit(0.0))

    return filled.select("bucket", F.array(*[weight(k) for k in range(FOLDS + 1)]).alias("weights"))


def _vectors(weights: DataFrame) -> Column:
    """The weights in steps of 1 / STEPS, as one array per fold and one for all, each bucket by bucket.

    Whole numbers add up alike in any order and take half the room: a row holds one such array for a moment.
    """
    rows = F.array_sort(F.collect_list(F.struct("bucket", "weights")))
    # Spark counts a function's parameters, so the number cannot be a default of the lambda.
    vector = lambda k: F.transform(rows, lambda r: F.round(r["weights"][k] * STEPS).cast("int"))
    return scalar(weights, F.array(*[vector(k) for k in range(FOLDS + 1)]))


def _mean_weight(vector: str, terms: str, buckets: int) -> Column:
    """Mean over hashes of their weights in the vector of that column."""
    place = lambda h: h.bitwiseAND(F.lit(buckets - 1)).cast("int")
    zero = F.lit(0).cast("long")
    # The vector is bound once a row: inside the sum it would be looked up for every hash.
    totals = F.transform(
        F.array(vector), lambda v: F.aggregate(terms, zero, lambda total, h: total + F.get(v, place(h)))
    )
    mean = F.get(totals, F.lit(0)) / (F.size(terms) * F.lit(float(STEPS)))
    return F.when(F.size(terms) > 0, mean).otherwise(F.lit(0.0))


def _terms() -> Column:
    return F.concat("__q_hashes", _windows(F.col("__q_hashes"), F.col("__q_n"), 2))


def threshold_step(ratios: DataFrame, recall: float = RECALL) -> int | None:
    """The highest step of ``ratio`` that keeps ``recall`` of the rows; none without rows.

    The steps are counted in a job, over all rows; what comes back is a histogram.
    """
    step = F.floor(F.col("ratio") * STEPS).alias("step")
    rows = sorted(ratios.groupBy(step).count().collect(), key=lambda r: r["step"])
    lost, allowed = 0, int((1 - recall) * sum(r["count"] for r in rows) + 1e-9)
    for r in rows:
        lost += r["count"]
        if lost > allowed:
            return r["step"]
    return None


def with_quality(
    docs: DataFrame,
    trusted: DataFrame,
    text: str = "text",
    out: str = "quality",
    judged: DataFrame | None = None,
    recall: float = RECALL,
    plain: bool = True,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all by default) and a struct ``out`` of statistics, the mean log ratios
    and the verdict ``kept``. ``log_ratio`` costs a second sum over the words; ``plain=False`` leaves it out.

    ``judged`` lists the ids of all good documents, which set the threshold; by default ``trusted``.
    """
    buckets = bucket_count(docs, trusted, text)
    require_broadcastable(buckets * (FOLDS + 1), "weights of the quality ratio")
    vectors = _vectors(materialize(bucket_weights(docs, trusted, text, buckets), "quality-weights"))

    kept = [c for c in (docs.columns if keep is None else keep) if c != out]
    # The documents' own columns travel in one, so that none can meet a name used here.
    own = F.struct(*[F.col(c) for c in kept], F.lit(0).alias("__q_end")).alias("__q_doc")
    step = docs.select(own, F.col("doc_id").alias("__q_id"), F.col(text).alias("__q_text"))
    step = with_base(step, "__q_text").withColumn("__q_terms", _terms())
    n = F.col("__q_n").cast("long")
    step = step.withColumn("__q_held", F.get(vectors, _fold("__q_text")))
    ratios = {"held_out_ratio": _mean_weight("__q_held", "__q_terms", buckets)}
    if plain:
        step = step.withColumn("__q_all", F.get(vectors, F.lit(FOLDS)))
        ratios = {"log_ratio": _mean_weight("__q_all", "__q_terms", buckets)} | ratios
    facts = F.struct(
        n.alias("n_words"),
        F.col("__q_chars").alias("word_chars"),
        F.col("__q_symbols").alias("n_symbols"),
        F.col("__q_dup_lines").alias("n_dup_lines"),
        F.col("__q_repeats").alias("n_repeat_words"),
        ((n < MIN_WORDS) | (100 * F.col("__q_repeats") > 50 * n)).alias("base_failed"),
        *[column.alias(name) for name, column in ratios.items()],
    )
    scored = materialize(step.select("__q_doc", "__q_id", facts.alias("__q_facts")), "quality-scored")

    good = (trusted if judged is None else judged).select(F.col("doc_id").alias("__q_id"))
    long = scored.where(F.col("__q_facts.n_words") >= MIN_WORDS)
    judged_ratios = long.join(good, "__q_id", "left_semi").select(F.col("__q_facts.held_out_ratio").alias("ratio"))
    least = threshold_step(judged_ratios, recall)
    reached = F.lit(True) if least is None else F.floor(F.col("__q_facts.held_out_ratio") * STEPS) >= least
    verdict = F.struct("__q_facts.*", (~F.col("__q_facts.base_failed") & reached).alias("kept"))
    return scored.select(*[F.col("__q_doc")[c].alias(c) for c in kept], verdict.alias(out))
