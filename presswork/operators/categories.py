"""Category counts, selection and the per-document labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from presswork.functions.maths import hash_key, let
from presswork.operators.ranking import dense_index
from presswork.session import materialize

# Labels live in every row of the indicator form, so their number is bounded.
MAX_LABELS = 10_000


def category_counts(docs: DataFrame) -> DataFrame:
    """Occurrences over all documents; a repeat inside a document counts again."""
    return (
        docs.select(F.explode("categories").alias("category"))
        .groupBy("category")
        .agg(F.count("*").alias("n"))
    )


def select_categories(counts: DataFrame, min_count: int = 20) -> DataFrame:
    """``n >= min_count`` get an index, most frequent first; the rest get null.

    The counts (one row per category) are stored first: they are used twice and
    may hang on a scan of all articles.
    """
    counts = materialize(counts, "counts")
    chosen = dense_index(
        counts.where(F.col("n") >= min_count), [F.desc("n"), F.asc("category")], "category_idx"
    )
    rest = counts.where(F.col("n") < min_count).withColumn(
        "category_idx", F.lit(None).cast("int")
    )
    return chosen.unionByName(rest).select(
        "category", "n", F.col("category_idx").isNotNull().alias("selected"), "category_idx"
    )


def selected_names(categories: DataFrame) -> list[str]:
    """The selected category names in index order; their number is checked."""
    rows = (
        categories.where("selected")
        .select("category", "category_idx")
        .limit(MAX_LABELS + 1)
        .collect()
    )
    if len(rows) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} categories selected; raise min_count")
    return [r["category"] for r in sorted(rows, key=lambda r: r["category_idx"])]


def has_category(category: str) -> Column:
    return F.array_contains("categories", category).cast("double")


def doc_category_index(docs: DataFrame, categories: DataFrame, key: str = "doc_id") -> DataFrame:
    """Distinct ``(doc_id, category_idx)`` of selected categories.

    Repeats are removed inside the row, so no distinct follows the join.
    """
    chosen = categories.where("selected").select("category", "category_idx")
    labels = docs.select(key, F.explode(F.array_distinct("categories")).alias("category"))
    return labels.join(chosen, "category").select(key, "category_idx")


def indicator(names: list[str]) -> Column:
    """0/1 array over the selected categories, in index order."""
    return F.transform(
        F.array(*[F.lit(n) for n in names]),
        lambda name: F.array_contains(F.col("categories"), name).cast("double"),
    )


def label_matrix(docs: DataFrame, names: list[str], key: str = "doc_id") -> DataFrame:
    """Every document with every selected category, from the row's own array."""
    return docs.select(key, F.posexplode(indicator(names)).alias("category_idx", "label"))


def label_support(labels: DataFrame) -> DataFrame:
    """Positive documents per category."""
    return labels.groupBy("category_idx").agg(F.sum("label").cast("bigint").alias("support"))


def drawn_category(seed: int, key: str = "doc_id") -> Column:
    """One category per document, uniform over all of its entries."""
    tagged = F.transform(
        F.col("categories"),
        lambda c, i: F.struct(hash_key(F.col(key), c, i, seed).alias("h"), c.alias("category")),
    )
    return let(tagged, F.array_min)["category"]


def single_label(docs: DataFrame, categories: DataFrame, seed: int = 42, key: str = "doc_id") -> DataFrame:
    """``truth``: the drawn category's index, or C ("other") if it is not selected."""
    chosen = categories.where("selected").select("category", "category_idx")
    other = chosen.agg(F.count("*").cast("int").alias("c")).scalar()
    drawn = docs.select(key, drawn_category(seed, key).alias("category"))
    return drawn.join(chosen, "category", "left").select(
        key, F.coalesce("category_idx", other).cast("int").alias("truth")
    )
