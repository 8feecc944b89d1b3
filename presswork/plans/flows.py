"""The three end-to-end flows: texts to weights, weights to reports, points to clusters."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from presswork.clustering.report import cluster_report
from presswork.operators import bags, categories, folds, reduce, scaling
from presswork.operators.metrics import classification_report
from presswork.session import materialize
from presswork.sources.stages import read_stage, write_stage


@dataclass
class Stages:
    """Stored results of ``preprocess``; each is read back from its own table."""

    docs: DataFrame  # doc_id, fold, categories
    categories: DataFrame  # category, n, selected, category_idx
    bag: DataFrame  # doc_id, term, tf, doc_len
    dictionary: DataFrame  # term, df, cf, term_idx
    rows: DataFrame  # doc_id, fold, categories, indices, weights


def preprocess(
    docs: DataFrame,
    out: str,
    min_category: int = 500,
    min_cf: int = 10,
    n_folds: int = 10,
    seed: int = 42,
    lexicon: DataFrame | None = None,
    stems: DataFrame | None = None,
    stopwords=None,
) -> Stages:
    """``(doc_id, categories, full_text)`` to folds of sparse TF-IDF rows.

    Articles are parsed and tokenised in one pass, which stores each document's
    counts and categories. Every later step reads columns of that stage.
    Documents whose words are all unknown keep an empty row.
    """
    spark = docs.sparkSession

    def stage(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        write_stage(df, f"{out}/{name}", partition_by)
        return read_stage(spark, f"{out}/{name}", None if partition_by else df.schema)

    texts = docs.select("doc_id", "categories", "full_text")
    if lexicon is None and stems is None:
        wide = stage(bags.wide_bags(texts, stopwords=stopwords), "bag")
        bag = bags.long_bags(wide)
    else:
        wide = stage(bags.word_counts(texts, stopwords=stopwords), "words")
        bag = stage(bags.joined_bags(wide, lexicon, stems, stopwords=stopwords), "bag")
    labels = stage(
        folds.assign_folds(wide.select("doc_id", "categories"), n_folds, seed), "docs"
    )
    counts = categories.category_counts(labels)
    chosen = stage(categories.select_categories(counts, min_category), "categories")
    dictionary = stage(bags.term_index(bags.word_dictionary(bag, min_cf)), "dictionary")
    weights = bags.tfidf_rows(bags.tfidf(bag, dictionary, labels))
    rows = labels.join(weights, "doc_id", "left").select(
        "doc_id",
        "categories",
        F.coalesce("indices", F.array().cast("array<int>")).alias("indices"),
        F.coalesce("weights", F.array().cast("array<double>")).alias("weights"),
        "fold",
    )
    return Stages(labels, chosen, bag, dictionary, stage(rows, "tfidf", "fold"))


def reduced_points(stages: Stages, dims: int = 100, test_fold: int | None = 2) -> DataFrame:
    """All folds projected on the principal components of the training folds."""
    keep = ("doc_id", "fold", "categories")
    size = stages.dictionary.count()
    return materialize(reduce.reduce_rows(stages.rows, size, dims, test_fold, keep), "reduced")


def train_and_report(points: DataFrame, stages: Stages, learner, test_fold: int = 2) -> DataFrame:
    """Scale on the training folds, fit one model per selected category, report.

    ``learner`` is ``f(data, names, test_fold) -> predictions``.
    """
    names = categories.selected_names(stages.categories)
    scaled = scaling.standard_scale(points, test_fold)
    return classification_report(learner(scaled, names, test_fold))


def cluster_and_score(points: DataFrame, stages: Stages, run, method: str, seed: int = 42) -> DataFrame:
    """Cluster unscaled points and compare with one drawn category per document.

    ``run`` is ``f(points, k) -> (doc_id, cluster)``; k is one more than the
    number of selected categories.
    """
    k = stages.categories.where("selected").count() + 1
    truth = categories.single_label(stages.docs, stages.categories, seed)
    began = time.perf_counter()
    assigned = materialize(run(points, k), method)
    return cluster_report(assigned, truth, method, time.perf_counter() - began)
