import hashlib
import math

import pytest
from pyspark.sql import functions as F

from presswork.operators import categories, folds


@pytest.mark.parametrize("n,k", [(1000, 10), (1003, 10), (7, 10), (25, 3), (0, 4)])
def test_folds_equal_a_full_sort(spark, n, k):
    df = spark.range(n).select(F.col("id").cast("string").alias("doc_id"))
    got = {r["doc_id"]: r["fold"] for r in folds.assign_folds(df, k, 5).collect()}
    order = sorted((str(i) for i in range(n)), key=lambda d: hashlib.md5(f"{d}:5".encode()).hexdigest())
    size = math.ceil(n / k) or 1
    assert got == {d: i // size for i, d in enumerate(order)}


def test_fold_assignment_is_a_projection(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("doc_id"))
    plan = folds.assign_folds(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def labels(spark):
    rows = [("1", ["a", "a", "b"]), ("2", ["b"]), ("3", ["c"]), ("4", ["a"])]
    return spark.createDataFrame(rows, "doc_id string, categories array<string>")


def test_category_counts_and_selection(spark):
    counts = categories.category_counts(labels(spark))
    assert {r["category"]: r["n"] for r in counts.collect()} == {"a": 3, "b": 2, "c": 1}
    chosen = categories.select_categories(counts, 2)
    assert categories.selected_names(chosen) == ["a", "b"]
    rest = [r for r in chosen.collect() if not r["selected"]]
    assert [(r["category"], r["category_idx"]) for r in rest] == [("c", None)]


def test_repeated_label_gives_one_row(spark):
    chosen = categories.select_categories(categories.category_counts(labels(spark)), 2)
    got = categories.doc_category_index(labels(spark), chosen).collect()
    assert sorted((r["doc_id"], r["category_idx"]) for r in got) == [("1", 0), ("1", 1), ("2", 1), ("4", 0)]


def test_single_label_maps_unselected_to_other(spark):
    chosen = categories.select_categories(categories.category_counts(labels(spark)), 2)
    got = {r["doc_id"]: r["truth"] for r in categories.single_label(labels(spark), chosen).collect()}
    assert got["3"] == 2 and got["2"] == 1 and got["4"] == 0 and got["1"] in (0, 1)
