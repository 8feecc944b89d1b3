"""The end-to-end flows as registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from presswork.clustering.centroids import kmeans
from presswork.learners.discriminant import linear_discriminant
from presswork.plans import flows, sql_parts as sp
from presswork.plans.learn_queries import rounded
from presswork.plans.text_queries import MIN_CF
from presswork.session import scratch_path
from presswork.sources import tables

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

MIN_CATEGORY = 50


def prepared(spark, sf_dir) -> flows.Stages:
    out = scratch_path(spark, "stages")
    return flows.preprocess(tables.docs(spark, sf_dir), out, MIN_CATEGORY, MIN_CF)


def preprocess_stages(spark, sf_dir):
    """All stages from text to folds; what each fold holds."""
    rows = prepared(spark, sf_dir).rows
    total = F.aggregate("weights", F.lit(0.0), lambda acc, w: acc + w)
    return rounded(
        rows.groupBy("fold").agg(
            F.count("*").alias("n_docs"),
            F.sum(F.size("indices")).alias("n_weights"),
            F.sum(total).alias("weight"),
        )
    )


QUERIES["preprocess_stages"] = preprocess_stages
ORACLE["preprocess_stages"] = f"""WITH {sp.tfidf(MIN_CF)}, folded AS ({sp.fold_of('docs')}),
    per_doc AS (SELECT doc_id, count(*) AS n, sum(weight) AS w FROM weights GROUP BY doc_id)
    SELECT fold, count(*) AS n_docs, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_weights,
           round(coalesce(sum(w), 0), 6) AS weight
    FROM folded LEFT JOIN per_doc USING (doc_id) GROUP BY fold"""


def train_and_report(spark, sf_dir):
    """Discriminant report over all selected categories on 100 components."""
    stages = prepared(spark, sf_dir)
    points = flows.reduced_points(stages, 100)
    return rounded(flows.train_and_report(points, stages, linear_discriminant))


def cluster_and_score(spark, sf_dir):
    """k-means on 100 components against the drawn categories."""
    stages = prepared(spark, sf_dir)
    points = flows.reduced_points(stages, 100)
    return flows.cluster_and_score(
        points, stages, lambda df, k: kmeans(df, k, "random"), "kmeans_random"
    )


QUERIES["train_and_report"] = train_and_report
QUERIES["cluster_and_score"] = cluster_and_score
