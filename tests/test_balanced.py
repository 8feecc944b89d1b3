import pytest
from pyspark.ml.functions import array_to_vector

from presswork.learners import estimators
from presswork.learners.relevance import LEAST, MOST, balanced, fit_per_category


def sizes(df):
    return df.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect()


@pytest.mark.parametrize("splits", [1, 60])
def test_partitions_do_not_follow_the_splits(spark, splits):
    cores = spark.sparkContext.defaultParallelism
    n = cores * LEAST + 100
    found = sizes(balanced(spark.range(0, n, 1, splits), n, 1))
    assert len(found) == cores
    assert sum(found) == n and max(found) < 1.2 * min(found)


def test_fits_at_the_same_time_share_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    n = cores * LEAST
    assert len(sizes(balanced(spark.range(0, n, 1, 9), n, 1, fits=cores))) == 1
    # However many fits there are, a partition stays bounded.
    assert len(sizes(balanced(spark.range(0, n, 1, 9), n, 3 * MOST // n, fits=cores))) == 3


def test_small_tables_stay_as_they_are(spark):
    assert len(sizes(balanced(spark.range(0, 100, 1, 3), 100, 1))) == 3


def test_a_fit_leaves_nothing_persisted(spark):
    persisted = spark.sparkContext._jsc.getPersistentRDDs
    before = len(persisted())
    n = LEAST + 10
    rows = spark.range(0, n, 1, 7).selectExpr(
        "id AS doc_id", "int(id % 5) AS fold", "array(double(id % 2), double(id % 7)) AS v", "array(IF(id % 2 = 0, 'a', 'b')) AS categories"
    )
    fit_per_category(estimators.decision_tree, rows.withColumn("features", array_to_vector("v")), ["a"], None)
    assert len(persisted()) == before
