"""Classification reports, cluster agreement and score histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from presswork.functions.maths import log_factorial
from presswork.session import materialize, scalar

TOTAL_ROW = -1  # category_idx of the "avg / total" line


def threshold_score(score: Column, cut: float = 0.5) -> Column:
    return F.when(score >= cut, 1.0).otherwise(0.0)


def confusion_counts(predictions: DataFrame, by=("category_idx",)) -> DataFrame:
    y, p = F.col("label"), F.col("prediction")
    return predictions.groupBy(*by).agg(
        F.sum((p * y)).cast("bigint").alias("tp"),
        F.sum(p * (1 - y)).cast("bigint").alias("fp"),
        F.sum((1 - p) * y).cast("bigint").alias("fn"),
    )


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(0.0)


def precision_recall_f1(counts: DataFrame) -> DataFrame:
    """Positive-class scores from counts; each is 0 where it is undefined."""
    keys = [c for c in counts.columns if c not in ("tp", "fp", "fn")]
    scored = counts.select(
        *keys,
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        (F.col("tp") + F.col("fn")).alias("support"),
    )
    both = (F.col("precision") > 0) & (F.col("recall") > 0)
    f1 = F.when(both, 2.0 / (1.0 / F.col("precision") + 1.0 / F.col("recall"))).otherwise(0.0)
    return scored.select(*keys, "precision", "recall", f1.alias("f1"), "support")


def classification_report(predictions: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One line per category and a support-weighted average line (index -1)."""
    lines = precision_recall_f1(confusion_counts(predictions, (*by, "category_idx")))
    both = lines.withColumn(
        "category_idx", F.explode(F.array(F.col("category_idx"), F.lit(TOTAL_ROW)))
    )
    total = F.col("category_idx") == TOTAL_ROW

    def average(name: str) -> Column:
        weighted = _ratio(F.sum(F.col(name) * F.col("support")), F.sum("support"))
        return F.when(total, weighted).otherwise(F.max(name)).alias(name)

    return both.groupBy(*by, "category_idx").agg(
        average("precision"), average("recall"), average("f1"), F.sum("support").alias("support")
    )


def macro_average(predictions: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Unweighted mean over categories."""
    lines = precision_recall_f1(confusion_counts(predictions, (*by, "category_idx")))
    means = [F.avg(c).alias(c) for c in ("precision", "recall", "f1")]
    return lines.groupBy(*by).agg(*means) if by else lines.agg(*means)


def area_under_curve(predictions: DataFrame) -> DataFrame:
    """``(category_idx, positives, negatives, auc)``: the share of pairs of a positive and a negative row
    that the score puts in order, ties counted half. Null where a side is empty.

    Equal scores are counted first. The sorted counts are range-partitioned over all categories; what lies
    below a partition is the sum of the partitions before it, so no task holds a category.
    """
    positive = F.col("label") == 1.0
    ties = predictions.groupBy("category_idx", "score").agg(
        F.sum(F.when(positive, 1).otherwise(0)).alias("pos"), F.sum(F.when(positive, 0).otherwise(1)).alias("neg")
    )
    keys = ["category_idx", "score"]
    ordered = ties.repartitionByRange(*keys).withColumn("part", F.spark_partition_id())
    stored = materialize(ordered, "auc-ties")
    here = W.partitionBy("part", "category_idx").orderBy("score").rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy("category_idx").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    below = stored.groupBy("category_idx", "part").agg(F.sum("neg").alias("neg"))
    below = below.select("category_idx", "part", F.coalesce(F.sum("neg").over(earlier), F.lit(0)).alias("below"))
    placed = stored.withColumn("within", F.coalesce(F.sum("neg").over(here), F.lit(0))).join(below, ["category_idx", "part"])
    won = F.sum(F.col("pos") * (F.col("below") + F.col("within") + F.col("neg") / 2))
    sums = placed.groupBy("category_idx").agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), won.alias("won"))
    pairs = F.col("positives") * F.col("negatives")
    return sums.select("category_idx", "positives", "negatives", F.when(pairs > 0, F.col("won") / pairs).alias("auc"))


# ------------------------------------------------------------ cluster agreement


def contingency(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("truth", "cluster").agg(F.count("*").alias("n"))


def _marginals(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = table.groupBy("truth").agg(F.sum("n").alias("a"))
    cols = table.groupBy("cluster").agg(F.sum("n").alias("b"))
    return rows, cols


def _entropy(sizes: DataFrame, size: str, total: Column) -> Column:
    p = F.col(size) / total
    return scalar(sizes.select((-p * F.log(p)).alias("h")), F.sum("h"))


def mutual_information(table: DataFrame) -> DataFrame:
    """One row: n, MI and both entropies of a contingency table."""
    rows, cols = _marginals(table)
    total = scalar(table, F.sum("n"))
    n = F.col("n")
    cells = table.join(rows, "truth").join(cols, "cluster").select(
        (n / total * F.log(n * total / (F.col("a") * F.col("b")))).alias("mi"), "n"
    )
    return cells.agg(F.sum("mi").alias("mi"), F.sum("n").alias("n")).select(
        "n",
        F.greatest(F.col("mi"), F.lit(0.0)).alias("mi"),
        _entropy(rows, "a", total).alias("h_truth"),
        _entropy(cols, "b", total).alias("h_cluster"),
    )


def expected_mutual_info(table: DataFrame) -> DataFrame:
    """E[MI] under random labelling with the same marginals.

    Cells depend on marginal sizes only, so distinct sizes carry multiplicities.
    The overlap is hypergeometric; by Hoeffding's bound its mass outside
    ``ab/N +- sqrt(40 * min(a, b))`` is below 2*exp(-80), less than a double can
    resolve, so the sum runs over that range only, whatever N is.
    """
    rows, cols = _marginals(table)
    total = scalar(table, F.sum("n"))
    a_sizes = rows.groupBy("a").agg(F.count("*").alias("na"))
    b_sizes = cols.groupBy("b").agg(F.count("*").alias("nb"))
    b_list = b_sizes.agg(F.collect_list(F.struct("b", "nb")).alias("v")).scalar()
    pairs = a_sizes.select("a", "na", total.alias("N"), F.inline(b_list))
    a, b, size = F.col("a"), F.col("b"), F.col("N")
    spread = F.sqrt(40.0 * F.least(a, b)) + 1.0
    low = F.greatest(F.lit(1).cast("bigint"), a + b - size, F.floor(a * (b / size) - spread))
    high = F.least(a, b, F.ceil(a * (b / size) + spread))
    steps = pairs.select(
        "*", F.explode(F.when(low <= high, F.sequence(low, high))).alias("k")
    )
    k = F.col("k")
    fixed = (
        log_factorial(a)
        + log_factorial(b)
        + log_factorial(size - a)
        + log_factorial(size - b)
        - log_factorial(size)
    )
    log_p = (
        fixed
        - log_factorial(k)
        - log_factorial(a - k)
        - log_factorial(b - k)
        - log_factorial(size - a - b + k)
    )
    term = F.col("na") * F.col("nb") * (k / size) * F.log((k / a) * (size / b)) * F.exp(log_p)
    return steps.agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("emi"))


def adjusted_mutual_info(table: DataFrame) -> DataFrame:
    """AMI with the "max" normaliser; identical partitions score 1."""
    emi = expected_mutual_info(table).scalar()
    info = mutual_information(table).withColumn("emi", emi)
    upper = F.greatest("h_truth", "h_cluster")
    score = (F.col("mi") - F.col("emi")) / (upper - F.col("emi"))
    trivial = (F.col("h_truth") == 0) & (F.col("h_cluster") == 0)
    return info.select(F.when(trivial, 1.0).otherwise(score).alias("ami"))


def normalized_mutual_info(table: DataFrame) -> DataFrame:
    """NMI with the geometric-mean normaliser."""
    info = mutual_information(table)
    scale = F.sqrt(F.col("h_truth") * F.col("h_cluster"))
    trivial = (F.col("h_truth") == 0) & (F.col("h_cluster") == 0)
    score = F.when(trivial, 1.0).when(scale > 0, F.col("mi") / scale).otherwise(0.0)
    return info.select(score.alias("nmi"))


# ------------------------------------------------------------------- histogram


def score_histogram(scores: DataFrame, bins: int = 10) -> DataFrame:
    """Counts per class in equal bins over the global score range."""
    bounds = scores.agg(F.struct(F.min("score").alias("lo"), F.max("score").alias("hi")).alias("r"))
    ranged = scores.select("label", "score", bounds.scalar().alias("r"))
    width = F.col("r.hi") - F.col("r.lo")
    slot = F.when(
        width > 0,
        F.least(F.floor((F.col("score") - F.col("r.lo")) * bins / width), F.lit(bins - 1)),
    ).otherwise(0)
    return (
        ranged.withColumn("bin", slot.cast("int"))
        .groupBy("label", "bin")
        .agg(F.count("*").alias("n"))
    )
