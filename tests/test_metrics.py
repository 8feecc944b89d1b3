import math

import pytest
from pyspark.sql import functions as F

from presswork.functions.maths import log_factorial
from presswork.operators import metrics


def test_log_factorial(spark):
    n = [0, 1, 5, 20, 21, 50, 1000, 10**9]
    rows = spark.createDataFrame([(v,) for v in n], "n bigint").select("n", log_factorial(F.col("n")).alias("l"))
    for r in rows.collect():
        assert math.isclose(r["l"], math.lgamma(r["n"] + 1), rel_tol=1e-12, abs_tol=1e-12)


def table(spark, pairs):
    df = spark.createDataFrame(pairs, "truth int, cluster int")
    return metrics.contingency(df)


def emi(pairs):
    n = len(pairs)
    a = [sum(p[0] == v for p in pairs) for v in {p[0] for p in pairs}]
    b = [sum(p[1] == v for p in pairs) for v in {p[1] for p in pairs}]
    out = 0.0
    for x in a:
        for y in b:
            for k in range(max(1, x + y - n), min(x, y) + 1):
                p = math.comb(x, k) * math.comb(n - x, y - k) / math.comb(n, y)
                out += p * k / n * math.log(n * k / (x * y))
    return out


PAIRS = [(i % 3, (i * i) % 5) for i in range(200)]


def test_expected_mutual_info(spark):
    got = metrics.expected_mutual_info(table(spark, PAIRS)).first()["emi"]
    assert math.isclose(got, emi(PAIRS), rel_tol=1e-9)


def test_agreement_properties(spark):
    same = table(spark, [(i % 4, (i + 1) % 4) for i in range(100)])
    assert math.isclose(metrics.adjusted_mutual_info(same).first()["ami"], 1.0)
    assert math.isclose(metrics.normalized_mutual_info(same).first()["nmi"], 1.0)
    there = metrics.adjusted_mutual_info(table(spark, PAIRS)).first()["ami"]
    back = metrics.adjusted_mutual_info(table(spark, [(b, a) for a, b in PAIRS])).first()["ami"]
    assert math.isclose(there, back, rel_tol=1e-9)
    assert 0 <= metrics.normalized_mutual_info(table(spark, PAIRS)).first()["nmi"] <= 1
    single = table(spark, [(0, i % 3) for i in range(30)])
    assert metrics.normalized_mutual_info(single).first()["nmi"] == 0.0


def test_expected_mutual_info_at_large_counts(spark):
    """Ten billion rows: the sum runs over a bounded range of overlaps."""
    big = spark.createDataFrame(
        [(t, c, 10**9) for t in range(2) for c in range(5)], "truth int, cluster int, n bigint"
    )
    got = metrics.expected_mutual_info(big).first()["emi"]
    assert 0 < got < 1e-4


def predictions(spark):
    rows = [(0, 1.0, 1.0), (0, 1.0, 0.0), (0, 0.0, 1.0), (1, 0.0, 0.0), (2, 1.0, 1.0), (2, 0.0, 0.0)]
    return spark.createDataFrame(rows, "category_idx int, label double, prediction double")


def test_report_lines_and_average(spark):
    got = {r["category_idx"]: r for r in metrics.classification_report(predictions(spark)).collect()}
    assert (got[0]["precision"], got[0]["recall"], got[0]["f1"], got[0]["support"]) == (0.5, 0.5, 0.5, 2)
    assert (got[1]["precision"], got[1]["recall"], got[1]["f1"], got[1]["support"]) == (0.0, 0.0, 0.0, 0)
    assert got[-1]["support"] == 3
    assert math.isclose(got[-1]["f1"], (0.5 * 2 + 1.0) / 3)


def test_macro_average(spark):
    assert metrics.macro_average(predictions(spark)).first()["f1"] == pytest.approx(0.5)


def test_histogram_puts_the_top_value_in_the_last_bin(spark):
    df = spark.createDataFrame([(0.0, float(i)) for i in range(11)], "label double, score double")
    got = {r["bin"]: r["n"] for r in metrics.score_histogram(df).collect()}
    assert got == {**{i: 1 for i in range(9)}, 9: 2}
    flat = spark.createDataFrame([(0.0, 1.0)] * 3, "label double, score double")
    assert [(r["bin"], r["n"]) for r in metrics.score_histogram(flat).collect()] == [(0, 3)]
