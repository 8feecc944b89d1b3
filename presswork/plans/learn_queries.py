"""Queries over features, learners and reports, with SQL where SQL can say it."""

from __future__ import annotations

from functools import partial

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from presswork.learners import crossfold, estimators, joint, joint_mlp
from presswork.learners.bayes import gaussian_nb, multinomial_nb
from presswork.learners.discriminant import linear_discriminant
from presswork.learners.joint_boost import adaboost
from presswork.learners.knn import bagging_knn, feature_draw, knn
from presswork.learners.relevance import binary_relevance, compare_classifiers
from presswork.operators import bags, metrics, plotdata, reduce, scaling
from presswork.operators.categories import has_category
from presswork.operators.folds import assign_folds, train_folds, held_out_fold
from presswork.operators.approximate import approximate_knn_join
from presswork.operators.neighbors import knn_join, points_of
from presswork.plans import sql_parts as sp
from presswork.plans.text_queries import MIN_CF, stored_bags
from presswork.session import materialize
from presswork.sources import tables

TEST_FOLD = 2
PLOTTED = "c0"  # the category of the plots over the plane

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at comparison precision; -0.0 becomes 0.0."""
    return df.select(
        *[
            (F.round(c, digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def long_features(df: DataFrame, keep=("doc_id", "fold")) -> DataFrame:
    return df.select(*keep, F.posexplode(vector_to_array("features")).alias("dim", "v"))


def scaled_points(spark, sf_dir) -> DataFrame:
    """Embeddings standardised on the training folds, as every learner gets them."""
    return scaling.standard_scale(tables.points(spark, sf_dir), TEST_FOLD)


def plane_points(spark, sf_dir) -> DataFrame:
    """First two dimensions, each scaled to [0, 1]."""
    return scaling.minmax_scale(scaling.first_dims(tables.points(spark, sf_dir), 2))


# -------------------------------------------------------------------- scaling

SQL_SCALED = f"""{sp.LONG_POINTS}, train_stats AS (
    SELECT dim, avg(v) AS m, stddev_pop(v) AS s FROM long_points WHERE fold <> {TEST_FOLD} GROUP BY dim),
scaled AS (
    SELECT doc_id, fold, category, dim, CASE WHEN s > 0 THEN (v - m) / s ELSE 0.0 END AS v
    FROM long_points JOIN train_stats USING (dim))"""

SQL_PLANE = f"""{sp.LONG_POINTS}, ranges AS (
    SELECT dim, min(v) AS lo, max(v) AS hi FROM long_points WHERE dim < 2 GROUP BY dim),
plane AS (
    SELECT doc_id, fold, category, dim, (v - lo) / (hi - lo) AS v
    FROM long_points JOIN ranges USING (dim))"""


@query(
    "standard_scale",
    f"""WITH {SQL_SCALED} SELECT doc_id, fold, CAST(dim AS INTEGER) AS dim,
        round(v, 6) + 0.0 AS v FROM scaled""",
)
def standard_scale(spark, sf_dir):
    return rounded(long_features(scaled_points(spark, sf_dir)))


@query(
    "first_dims",
    f"""WITH {sp.LONG_POINTS} SELECT doc_id, fold, CAST(dim AS INTEGER) AS dim,
        round(v, 6) + 0.0 AS v FROM long_points WHERE dim < 2""",
)
def first_dims(spark, sf_dir):
    return rounded(long_features(scaling.first_dims(tables.points(spark, sf_dir), 2)))


@query(
    "minmax_scale",
    f"""WITH {SQL_PLANE} SELECT doc_id, fold, CAST(dim AS INTEGER) AS dim,
        round(v, 6) + 0.0 AS v FROM plane""",
)
def minmax_scale(spark, sf_dir):
    return rounded(long_features(plane_points(spark, sf_dir)))


# ------------------------------------------------------------------ reduction


@query("pca_reduce")
def pca_reduce(spark, sf_dir):
    """Ten components fitted on the training folds, all folds projected."""
    return long_features(reduce.pca_reduce(tables.points(spark, sf_dir), 10, TEST_FOLD))


def sparse_rows(spark, sf_dir) -> tuple[DataFrame, int]:
    """TF-IDF rows of every document with fold and categories; dictionary size."""
    docs = materialize(
        assign_folds(tables.docs(spark, sf_dir).select("doc_id", "categories")), "docs"
    )
    long = stored_bags(spark, sf_dir)
    dictionary = bags.term_index(bags.word_dictionary(long, MIN_CF))
    weights = bags.tfidf(long, dictionary, docs)
    rows = docs.join(bags.tfidf_rows(weights), "doc_id", "left").select(
        "doc_id",
        "fold",
        "categories",
        F.coalesce("indices", F.array().cast("array<int>")).alias("indices"),
        F.coalesce("weights", F.array().cast("array<double>")).alias("weights"),
    )
    return materialize(rows, "rows"), dictionary.count()


def reduced_docs(spark, sf_dir, k: int = 20) -> DataFrame:
    """Documents as k principal coordinates of their TF-IDF rows."""
    rows, size = sparse_rows(spark, sf_dir)
    keep = ("doc_id", "fold", "categories")
    return materialize(reduce.reduce_rows(rows, size, k, TEST_FOLD, keep), "reduced")


@query("pca_tfidf")
def pca_tfidf(spark, sf_dir):
    return long_features(reduced_docs(spark, sf_dir))


@query("pca_incremental")
def pca_incremental(spark, sf_dir):
    """Fold sketches from one scan, the training ones merged, all folds projected."""
    rows, size = sparse_rows(spark, sf_dir)
    sketches = materialize(reduce.fold_sketches(rows, size, 20), "sketches")
    merged = reduce.merge_sketches(train_folds(sketches, TEST_FOLD))
    n_train = train_folds(rows, TEST_FOLD).count()
    model = reduce.components_of(merged, n_train, size, 20)
    return long_features(reduce.project(rows, model))


# ----------------------------------------------------- closed-form classifiers


def sql_gaussian(source: str, train: str, test: str) -> str:
    """Gaussian naive Bayes log odds; ``source`` has doc_id, fold, category, dim, v."""
    return f"""{sp.POINT_CATEGORIES}, gnb_train AS (SELECT * FROM {source} WHERE {train}),
smoothing AS (
    SELECT 1e-9 * max(s) AS eps FROM (SELECT var_pop(v) AS s FROM gnb_train GROUP BY dim)),
gnb_stats AS (
    SELECT c.category_idx, t.category = c.category AS y, dim, avg(v) AS m,
           var_pop(v) + (SELECT eps FROM smoothing) AS s, count(*) AS n
    FROM gnb_train t, categories c GROUP BY ALL),
gnb_lines AS (
    SELECT t.doc_id, t.category, g.category_idx, y,
           ln(max(n)) - 0.5 * sum(ln(s) + (v - m) ** 2 / s) AS jll
    FROM (SELECT * FROM {source} WHERE {test}) t JOIN gnb_stats g USING (dim) GROUP BY ALL),
gnb AS (
    SELECT doc_id, category_idx,
           CAST(l.category = c.category AS DOUBLE) AS label,
           max(jll) FILTER (WHERE y) - max(jll) FILTER (WHERE NOT y) AS score,
           CAST(max(jll) FILTER (WHERE y) > max(jll) FILTER (WHERE NOT y) AS DOUBLE) AS prediction
    FROM gnb_lines l JOIN categories c USING (category_idx)
    GROUP BY doc_id, category_idx, l.category, c.category)"""


SQL_GNB = f"{SQL_SCALED}, {sql_gaussian('scaled', f'fold <> {TEST_FOLD}', f'fold = {TEST_FOLD}')}"


def sql_report(predictions: str) -> str:
    """Lines per category and the weighted average, from a predictions relation."""
    return f"""lines AS (
    SELECT category_idx, sum(prediction * label) AS tp, sum(prediction * (1 - label)) AS fp,
           sum((1 - prediction) * label) AS fn FROM {predictions} GROUP BY category_idx),
prf AS (
    SELECT category_idx,
           CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
           CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
           CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
           CAST(tp + fn AS BIGINT) AS support FROM lines),
report AS (
    SELECT * FROM prf UNION ALL
    SELECT -1, coalesce(sum(precision * support) / sum(support), 0),
           coalesce(sum(recall * support) / sum(support), 0),
           coalesce(sum(f1 * support) / sum(support), 0), CAST(sum(support) AS BIGINT) FROM prf)"""


REPORT_COLUMNS = """CAST(category_idx AS INTEGER) AS category_idx, round(precision, 6) AS precision,
    round(recall, 6) AS recall, round(f1, 6) AS f1, support"""


@query(
    "gaussian_nb",
    f"""WITH {SQL_GNB} SELECT doc_id, category_idx, label, round(score, 6) + 0.0 AS score, prediction
        FROM gnb""",
)
def gaussian(spark, sf_dir):
    return rounded(gaussian_nb(scaled_points(spark, sf_dir), tables.point_categories(spark, sf_dir), TEST_FOLD))


SQL_MNB = f"""{sp.tfidf(MIN_CF)}, folded AS ({sp.fold_of('docs')}),
categories AS (
    SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS category_idx
    FROM (SELECT DISTINCT lang AS category FROM documents WHERE lang IS NOT NULL)),
marked AS (
    SELECT doc_id, fold, category_idx, list_contains(categories.category_list, category) AS y
    FROM (SELECT doc_id, fold, categories AS category_list FROM folded) categories, categories c),
mass AS (
    SELECT category_idx, y, term_idx, sum(weight) AS w
    FROM weights JOIN marked USING (doc_id) WHERE fold <> {TEST_FOLD} GROUP BY ALL),
sides AS (SELECT category_idx, y FROM categories, (VALUES (true), (false)) s(y)),
totals AS (
    SELECT s.category_idx, s.y, coalesce(sum(w), 0) + (SELECT count(*) FROM dictionary) AS z
    FROM sides s LEFT JOIN mass m ON s.category_idx = m.category_idx AND s.y = m.y GROUP BY ALL),
priors AS (
    SELECT category_idx, y, count(*) AS n FROM marked WHERE fold <> {TEST_FOLD} GROUP BY ALL),
test_docs AS (SELECT * FROM marked WHERE fold = {TEST_FOLD}),
evidence AS (
    SELECT t.doc_id, t.category_idx, s.y,
           sum(weight * ln((coalesce(w, 0) + 1) / z)) AS ll
    FROM test_docs t JOIN weights USING (doc_id)
    JOIN totals s ON s.category_idx = t.category_idx
    LEFT JOIN mass m ON m.category_idx = s.category_idx AND m.y = s.y
        AND m.term_idx = weights.term_idx
    GROUP BY ALL),
mnb AS (
    SELECT t.doc_id, t.category_idx, CAST(t.y AS DOUBLE) AS label,
           ln(p1.n) + coalesce(e1.ll, 0) - ln(p0.n) - coalesce(e0.ll, 0) AS score
    FROM test_docs t
    JOIN priors p1 ON p1.category_idx = t.category_idx AND p1.y
    JOIN priors p0 ON p0.category_idx = t.category_idx AND NOT p0.y
    LEFT JOIN evidence e1 ON e1.doc_id = t.doc_id AND e1.category_idx = t.category_idx AND e1.y
    LEFT JOIN evidence e0 ON e0.doc_id = t.doc_id AND e0.category_idx = t.category_idx AND NOT e0.y)"""


@query(
    "multinomial_nb",
    f"""WITH {SQL_MNB} SELECT doc_id, category_idx, label, round(score, 6) + 0.0 AS score,
        CAST(score > 0 AS DOUBLE) AS prediction FROM mnb""",
)
def multinomial(spark, sf_dir):
    """Languages of the held-out documents from raw TF-IDF weights."""
    docs = materialize(
        assign_folds(tables.docs(spark, sf_dir).select("doc_id", "categories")), "docs"
    )
    long = stored_bags(spark, sf_dir)
    dictionary = bags.term_index(bags.word_dictionary(long, MIN_CF))
    weights = bags.tfidf(long, dictionary, docs).join(docs.select("doc_id", "fold"), "doc_id")
    return rounded(multinomial_nb(materialize(weights, "weights"), docs, dictionary, tables.languages(spark, sf_dir), TEST_FOLD))


def sql_mnb_folds() -> str:
    """As above with every fold held out once; ``f`` is the fold held out."""
    return f"""{sp.tfidf(MIN_CF)}, folded AS ({sp.fold_of('docs')}),
categories AS (
    SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS category_idx
    FROM (SELECT DISTINCT lang AS category FROM documents WHERE lang IS NOT NULL)),
marked AS (
    SELECT doc_id, fold, category_idx, list_contains(d.category_list, category) AS y
    FROM (SELECT doc_id, fold, categories AS category_list FROM folded) d, categories c),
own AS (
    SELECT category_idx, y, term_idx, fold, sum(weight) AS w
    FROM weights JOIN marked USING (doc_id) GROUP BY ALL),
held AS (SELECT DISTINCT fold AS f FROM folded),
mass AS (SELECT f, category_idx, y, term_idx, sum(w) AS w FROM own JOIN held ON own.fold <> held.f GROUP BY ALL),
sides AS (SELECT f, category_idx, y FROM held, categories, (VALUES (true), (false)) s(y)),
totals AS (
    SELECT s.f, s.category_idx, s.y, coalesce(sum(w), 0) + (SELECT count(*) FROM dictionary) AS z
    FROM sides s LEFT JOIN mass m ON s.category_idx = m.category_idx AND s.y = m.y AND s.f = m.f GROUP BY ALL),
priors AS (
    SELECT f, category_idx, y, count(*) AS n FROM marked JOIN held ON fold <> f GROUP BY ALL),
evidence AS (
    SELECT t.doc_id, t.category_idx, s.y, sum(weight * ln((coalesce(w, 0) + 1) / z)) AS ll
    FROM marked t JOIN weights USING (doc_id)
    JOIN totals s ON s.category_idx = t.category_idx AND s.f = t.fold
    LEFT JOIN mass m ON m.category_idx = s.category_idx AND m.y = s.y AND m.f = s.f
        AND m.term_idx = weights.term_idx
    GROUP BY ALL)
SELECT t.doc_id, CAST(t.fold AS INTEGER) AS fold, t.category_idx, CAST(t.y AS DOUBLE) AS label,
       round(ln(p1.n) + coalesce(e1.ll, 0) - ln(p0.n) - coalesce(e0.ll, 0), 5) + 0.0 AS score
FROM marked t
JOIN priors p1 ON p1.category_idx = t.category_idx AND p1.f = t.fold AND p1.y
JOIN priors p0 ON p0.category_idx = t.category_idx AND p0.f = t.fold AND NOT p0.y
LEFT JOIN evidence e1 ON e1.doc_id = t.doc_id AND e1.category_idx = t.category_idx AND e1.y
LEFT JOIN evidence e0 ON e0.doc_id = t.doc_id AND e0.category_idx = t.category_idx AND NOT e0.y"""


@query("multinomial_nb_folds", f"WITH {sql_mnb_folds()}")
def multinomial_folds(spark, sf_dir):
    """Every document's language, predicted from the other nine folds; all languages of the table."""
    names = tables.languages(spark, sf_dir)
    texts = assign_folds(tables.docs(spark, sf_dir))
    docs = materialize(texts.select("doc_id", "categories", "fold"), "docs")
    # Fold and labels come along with the words: joined later they would move every word of a large collection.
    carried = ("fold", "kind")
    long = stored_bags(spark, sf_dir, crossfold.carry_kinds(texts, docs, names), carried)
    dictionary = bags.term_index(bags.word_dictionary(long, MIN_CF))
    weights = materialize(bags.tfidf(long, dictionary, docs, keep=("doc_id", *carried)), "weights")
    found = crossfold.multinomial_nb_folds(weights, docs, materialize(dictionary, "terms"), names)
    return rounded(found.drop("prediction"), 5)


SQL_GNB_FOLDS = f"""{sp.LONG_POINTS}, {sp.POINT_CATEGORIES}, held AS (SELECT DISTINCT fold AS f FROM long_points),
smoothing AS (
    SELECT f, 1e-9 * max(s) AS eps FROM (
        SELECT f, var_pop(v) AS s FROM long_points JOIN held ON fold <> f GROUP BY f, dim) GROUP BY f),
gnb_stats AS (
    SELECT f, c.category_idx, t.category = c.category AS y, dim, avg(v) AS m,
           var_pop(v) + any_value(eps) AS s, count(*) AS n
    FROM long_points t JOIN held ON t.fold <> held.f JOIN smoothing USING (f), categories c GROUP BY ALL),
gnb_lines AS (
    SELECT t.doc_id, t.fold, t.category, g.category_idx, y,
           ln(max(n)) - 0.5 * sum(ln(s) + (v - m) ** 2 / s) AS jll
    FROM long_points t JOIN gnb_stats g ON g.dim = t.dim AND g.f = t.fold GROUP BY ALL),
gnb AS (
    SELECT doc_id, fold, category_idx, CAST(l.category = c.category AS DOUBLE) AS label,
           max(jll) FILTER (WHERE y) - max(jll) FILTER (WHERE NOT y) AS score
    FROM gnb_lines l JOIN categories c USING (category_idx)
    GROUP BY doc_id, fold, category_idx, l.category, c.category)"""


@query(
    "gaussian_nb_folds",
    f"""WITH {SQL_GNB_FOLDS} SELECT doc_id, CAST(fold AS INTEGER) AS fold, category_idx, label, round(score, 5) + 0.0 AS score,
        CAST(score > 0 AS DOUBLE) AS prediction FROM gnb""",
)
def gaussian_folds(spark, sf_dir):
    """Every vector scored by the model of the other nine folds."""
    return rounded(crossfold.gaussian_nb_folds(tables.points(spark, sf_dir), tables.point_categories(spark, sf_dir)), 5)


SQL_AUC = """ranked AS (
    SELECT category_idx, label, rank() OVER w + (count(*) OVER (PARTITION BY category_idx, score) - 1) / 2.0 AS r
    FROM {0} WINDOW w AS (PARTITION BY category_idx ORDER BY score)),
sides AS (
    SELECT category_idx, sum(r) FILTER (WHERE label = 1) AS ranks,
           count(*) FILTER (WHERE label = 1) AS positives, count(*) FILTER (WHERE label = 0) AS negatives
    FROM ranked GROUP BY category_idx)
SELECT CAST(category_idx AS INTEGER) AS category_idx, positives, negatives,
       round((ranks - positives * (positives + 1) / 2.0) / (positives * negatives), 6) AS auc FROM sides"""


@query("gaussian_nb_auc", f"WITH {SQL_GNB_FOLDS}, {SQL_AUC.format('gnb')}")
def gaussian_auc(spark, sf_dir):
    """Area under the curve per category over all ten held-out folds."""
    return rounded(metrics.area_under_curve(crossfold.gaussian_nb_folds(tables.points(spark, sf_dir), tables.point_categories(spark, sf_dir))))


@query(
    "pca_rotation",
    f"""WITH {sp.LONG_POINTS}, means AS (
            SELECT dim, avg(v) AS m FROM long_points WHERE fold <> {TEST_FOLD} GROUP BY dim)
        SELECT doc_id, round(sum((v - m) ** 2), 6) AS norm
        FROM long_points JOIN means USING (dim) GROUP BY doc_id""",
)
def pca_rotation(spark, sf_dir):
    """With every component kept, distances from the training mean are unchanged."""
    data = tables.points(spark, sf_dir)
    size = len(data.first()["features"])
    x = vector_to_array("features")
    norm = F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v)
    return rounded(reduce.pca_reduce(data, size, TEST_FOLD).select("doc_id", norm.alias("norm")))


@query("linear_discriminant")
def discriminant(spark, sf_dir):
    return linear_discriminant(scaled_points(spark, sf_dir), tables.point_categories(spark, sf_dir), TEST_FOLD)


# ------------------------------------------------------------------ neighbours

SQL_NEAR = f"""{sp.POINTS}, near AS (
    SELECT q.doc_id AS id, p.doc_id AS neighbor, p.category, list_distance(q.x, p.x) AS distance,
           row_number() OVER (PARTITION BY q.doc_id ORDER BY list_distance(q.x, p.x), p.doc_id) AS rank
    FROM points q, points p WHERE q.fold = {TEST_FOLD} AND p.fold <> {TEST_FOLD}
    QUALIFY rank <= 5)"""


@query(
    "nearest_neighbors",
    f"""WITH {SQL_NEAR} SELECT id, neighbor, round(distance, 6) AS distance,
        CAST(rank AS INTEGER) AS rank FROM near""",
)
def nearest_neighbors(spark, sf_dir):
    data = tables.points(spark, sf_dir)
    test, train = held_out_fold(data, TEST_FOLD), train_folds(data, TEST_FOLD)
    return rounded(knn_join(points_of(test), points_of(train), 5))


@query("approximate_neighbors")
def approximate_neighbors(spark, sf_dir):
    points = materialize(points_of(tables.points(spark, sf_dir)), "points")
    return rounded(approximate_knn_join(points.where("id % 50 = 0"), points, 5, exclude_self=True))


SQL_KNN = f"""{SQL_SCALED}, {sp.POINT_CATEGORIES}, packed AS (
    SELECT doc_id, fold, category, list(v ORDER BY dim) AS z FROM scaled GROUP BY ALL),
near AS (
    SELECT q.doc_id, q.category AS own, p.category,
    FROM packed q, packed p WHERE q.fold = {TEST_FOLD} AND p.fold <> {TEST_FOLD}
    QUALIFY row_number() OVER (PARTITION BY q.doc_id ORDER BY list_distance(q.z, p.z), p.doc_id) <= 5),
knn AS (
    SELECT doc_id, category_idx, CAST(own = c.category AS DOUBLE) AS label,
           avg(CAST(near.category = c.category AS DOUBLE)) AS score,
           CAST(avg(CAST(near.category = c.category AS DOUBLE)) > 0.5 AS DOUBLE) AS prediction
    FROM near, categories c GROUP BY ALL)"""


@query(
    "knn",
    f"WITH {SQL_KNN} SELECT doc_id, category_idx, label, round(score, 6) AS score, prediction FROM knn",
)
def knn_votes(spark, sf_dir):
    return rounded(knn(scaled_points(spark, sf_dir), tables.point_categories(spark, sf_dir), TEST_FOLD))


def _sql_bagging(members: int = 10, size: int = 10, d: int = 64, seed: int = 42) -> str:
    chosen = ", ".join(
        f"({m}, [{', '.join(str(i + 1) for i in feature_draw(m, d, size, seed))}])"
        for m in range(members)
    )
    steps = [
        "0.36787944117144233", "0.7357588823428847", "0.9196986029286058", "0.9810118431238462",
        "0.9963401531726563", "0.9994058151824183", "0.999916758850712", "0.9999897508033253",
        "0.999998874797402", "0.9999998885745217",
    ]
    count = " + ".join(f"CAST(u >= {s} AS INTEGER)" for s in steps)
    return f"""{SQL_SCALED}, {sp.POINT_CATEGORIES}, packed AS (
    SELECT doc_id, fold, category, list(v ORDER BY dim) AS z FROM scaled GROUP BY ALL),
members(member, dims) AS (VALUES {chosen}),
views AS (
    SELECT member, doc_id, fold, category, list_select(z, dims) AS z,
           CAST(('0x' || md5(concat_ws(':', 'row', member, doc_id, '{seed}'))[1:8]) AS BIGINT)
               / 4294967296.0 AS u
    FROM packed, members),
sampled AS (
    SELECT member, doc_id, category, z, unnest(range(0, {count})) AS copy
    FROM views WHERE fold <> {TEST_FOLD}),
near AS (
    SELECT member, q.doc_id, q.category AS own, p.category
    FROM (SELECT * FROM views WHERE fold = {TEST_FOLD}) q JOIN sampled p USING (member)
    QUALIFY row_number() OVER (
        PARTITION BY member, q.doc_id ORDER BY list_distance(q.z, p.z), p.doc_id, copy) <= 5),
votes AS (
    SELECT doc_id, category_idx, own = c.category AS y,
           avg(CAST(near.category = c.category AS DOUBLE)) AS score
    FROM near, categories c GROUP BY ALL)
SELECT doc_id, category_idx, CAST(y AS DOUBLE) AS label, round(score, 6) AS score,
       CAST(round(score, 9) > 0.5 AS DOUBLE) AS prediction FROM votes"""


@query("bagging_knn", f"WITH {_sql_bagging()}")
def bagged(spark, sf_dir):
    votes = bagging_knn(scaled_points(spark, sf_dir), tables.point_categories(spark, sf_dir), TEST_FOLD)
    settled = votes.withColumn("prediction", (F.round("score", 9) > 0.5).cast("double"))
    return rounded(settled)


# -------------------------------------------------------------- MLlib learners

FITTED = {
    "logistic_regression": estimators.logistic_regression,
    "linear_svm": estimators.linear_svm,
    "decision_tree": estimators.decision_tree,
    "mlp": estimators.mlp,
    "bagging_trees": estimators.bagging_trees,
    "random_forest": estimators.random_forest,
    "gradient_boost_stumps": estimators.gradient_boost_stumps,
    "gradient_boost_depth2": estimators.gradient_boost_depth2,
}

LEARNERS = {
    **{name: partial(binary_relevance, make) for name, make in FITTED.items()},
    "mlp": joint_mlp.mlp,
    "gaussian_nb": gaussian_nb,
    "knn": knn,
    "linear_discriminant": linear_discriminant,
    "adaboost": adaboost,
    "bagging_knn": bagging_knn,
}


def _fitted(learner):
    def run(spark, sf_dir):
        """Predictions for the held-out fold, one row per document and category."""
        return learner(scaled_points(spark, sf_dir), tables.point_categories(spark, sf_dir), TEST_FOLD)

    return run


for _name in [*FITTED, "adaboost"]:
    QUERIES[_name] = _fitted(LEARNERS[_name])


@query("logistic_regression_joint")
def logistic_regression_joint(spark, sf_dir):
    """All categories in one optimiser; the same models as ``logistic_regression``."""
    return joint.logistic_regression(scaled_points(spark, sf_dir), tables.point_categories(spark, sf_dir), TEST_FOLD)


@query("knn_auc", f"WITH {SQL_KNN}, {SQL_AUC.format('(SELECT * REPLACE (round(score, 9) AS score) FROM knn)')}")
def knn_auc(spark, sf_dir):
    """Area under the curve of votes, where most scores are ties."""
    votes = knn(scaled_points(spark, sf_dir), tables.point_categories(spark, sf_dir), TEST_FOLD).withColumn("score", F.round("score", 9))
    return rounded(metrics.area_under_curve(votes))


@query("gradient_boost_auc")
def gradient_boost_auc(spark, sf_dir):
    """The measure that the boosted depth-2 trees are tuned by, on the held-out fold."""
    learner = LEARNERS["gradient_boost_depth2"]
    return rounded(metrics.area_under_curve(learner(scaled_points(spark, sf_dir), tables.point_categories(spark, sf_dir), TEST_FOLD)))


@query("news_logistic_regression")
def news_logistic_regression(spark, sf_dir):
    """Text to report: TF-IDF, components, scaling, one model per language."""
    data = scaling.standard_scale(reduced_docs(spark, sf_dir), TEST_FOLD)
    predictions = LEARNERS["logistic_regression"](data, tables.languages(spark, sf_dir), TEST_FOLD)
    return rounded(metrics.classification_report(predictions))


@query("mlp_tfidf")
def mlp_tfidf(spark, sf_dir):
    """The perceptron on documents, through the reduced TF-IDF input."""
    data = scaling.standard_scale(reduced_docs(spark, sf_dir), TEST_FOLD)
    return LEARNERS["mlp"](data, tables.languages(spark, sf_dir), TEST_FOLD)


# ------------------------------------------------------------------- reporting


@query(
    "threshold_score",
    f"""WITH {SQL_KNN} SELECT doc_id, category_idx, CAST(score >= 0.4 AS DOUBLE) AS prediction
        FROM knn""",
)
def threshold_score(spark, sf_dir):
    """Any score column can be cut anew; here two of five votes suffice."""
    scores = knn(scaled_points(spark, sf_dir), tables.point_categories(spark, sf_dir), TEST_FOLD)
    cut = metrics.threshold_score(F.round("score", 9), 0.4)
    return scores.select("doc_id", "category_idx", cut.alias("prediction"))


def gnb_predictions(spark, sf_dir) -> DataFrame:
    return gaussian_nb(scaled_points(spark, sf_dir), tables.point_categories(spark, sf_dir), TEST_FOLD)


@query(
    "confusion_counts",
    f"""WITH {SQL_GNB}, {sql_report('gnb')} SELECT category_idx, CAST(tp AS BIGINT) AS tp,
        CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn FROM lines""",
)
def confusion_counts(spark, sf_dir):
    return metrics.confusion_counts(gnb_predictions(spark, sf_dir))


@query(
    "precision_recall_f1",
    f"WITH {SQL_GNB}, {sql_report('gnb')} SELECT {REPORT_COLUMNS} FROM prf",
)
def precision_recall_f1(spark, sf_dir):
    counts = metrics.confusion_counts(gnb_predictions(spark, sf_dir))
    return rounded(metrics.precision_recall_f1(counts))


@query(
    "classification_report",
    f"WITH {SQL_GNB}, {sql_report('gnb')} SELECT {REPORT_COLUMNS} FROM report",
)
def classification_report(spark, sf_dir):
    return rounded(metrics.classification_report(gnb_predictions(spark, sf_dir)))


@query(
    "macro_average",
    f"""WITH {SQL_GNB}, {sql_report('gnb')} SELECT round(avg(precision), 6) AS precision,
        round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1 FROM prf""",
)
def macro_average(spark, sf_dir):
    return rounded(metrics.macro_average(gnb_predictions(spark, sf_dir)))


@query(
    "compare_classifiers",
    f"""WITH {SQL_GNB}, {SQL_KNN.replace(SQL_SCALED + ', ' + sp.POINT_CATEGORIES + ', ', '')},
        both_models AS (
            SELECT 'gaussian_nb' AS model, category_idx, label, prediction FROM gnb
            UNION ALL SELECT 'knn', category_idx, label, prediction FROM knn),
        lines AS (SELECT model, category_idx, sum(prediction * label) AS tp,
            sum(prediction * (1 - label)) AS fp, sum((1 - prediction) * label) AS fn
            FROM both_models GROUP BY ALL),
        prf AS (SELECT model, category_idx,
            CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
            CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
            CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
            CAST(tp + fn AS BIGINT) AS support FROM lines)
        SELECT model, {REPORT_COLUMNS} FROM (
            SELECT * FROM prf UNION ALL
            SELECT model, -1, sum(precision * support) / sum(support),
                sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
                CAST(sum(support) AS BIGINT) FROM prf GROUP BY model)""",
)
def compare(spark, sf_dir):
    """Two learners on one split; the fit seconds are left out of the comparison."""
    learners = {name: LEARNERS[name] for name in ("gaussian_nb", "knn")}
    data = materialize(scaled_points(spark, sf_dir), "scaled")
    return rounded(compare_classifiers(learners, data, tables.point_categories(spark, sf_dir), TEST_FOLD).drop("fit_seconds"))


SQL_RESUBSTITUTION = f"{SQL_PLANE}, {sql_gaussian('plane', 'true', 'true')}"


@query(
    "resubstitution_report",
    f"WITH {SQL_RESUBSTITUTION}, {sql_report('gnb')} SELECT {REPORT_COLUMNS} FROM report",
)
def resubstitution_report(spark, sf_dir):
    """Fitted and scored on all rows of the first two dimensions in [0, 1]."""
    return rounded(
        metrics.classification_report(gaussian_nb(plane_points(spark, sf_dir), tables.point_categories(spark, sf_dir), None))
    )


@query("resubstitution_boosting")
def resubstitution_boosting(spark, sf_dir):
    """AdaBoost and boosted stumps for one category on two dimensions."""
    data = materialize(plane_points(spark, sf_dir), "plane")
    learners = {name: LEARNERS[name] for name in ("adaboost", "gradient_boost_stumps")}
    return compare_classifiers(learners, data, [PLOTTED], None).drop("fit_seconds")


# ------------------------------------------------------------------- plot data

# Linear discriminant of one category on the unit square, with the 2x2 inverse
# written out.
SQL_PLANE_LDA = f"""{SQL_PLANE}, xy AS (
    SELECT doc_id, category, max(v) FILTER (WHERE dim = 0) AS x, max(v) FILTER (WHERE dim = 1) AS y
    FROM plane GROUP BY doc_id, category),
lda_sides AS (
    SELECT category = '{PLOTTED}' AS pos, count(*) AS n, avg(x) AS mx, avg(y) AS my,
           var_pop(x) * count(*) AS sxx, var_pop(y) * count(*) AS syy,
           covar_pop(x, y) * count(*) AS sxy FROM xy GROUP BY 1),
lda_sums AS (
    SELECT sum(sxx) / (sum(n) - 2) AS a, sum(sxy) / (sum(n) - 2) AS b, sum(syy) / (sum(n) - 2) AS c,
           max(mx) FILTER (WHERE pos) AS mx1, max(my) FILTER (WHERE pos) AS my1,
           max(mx) FILTER (WHERE NOT pos) AS mx0, max(my) FILTER (WHERE NOT pos) AS my0,
           ln(max(n) FILTER (WHERE pos)) - ln(max(n) FILTER (WHERE NOT pos)) AS prior FROM lda_sides),
lda_weights AS (
    SELECT *, (c * (mx1 - mx0) - b * (my1 - my0)) / (a * c - b * b) AS wx,
           (a * (my1 - my0) - b * (mx1 - mx0)) / (a * c - b * b) AS wy FROM lda_sums),
lda AS (
    SELECT doc_id, CAST(0 AS INTEGER) AS category_idx, CAST(category = '{PLOTTED}' AS DOUBLE) AS label,
           prior + wx * (x - (mx1 + mx0) / 2) + wy * (y - (my1 + my0) / 2) AS score
    FROM xy, lda_weights)"""


@query(
    "plane_discriminant",
    f"""WITH {SQL_PLANE_LDA} SELECT doc_id, category_idx, label, round(score, 6) + 0.0 AS score,
        CAST(score > 0 AS DOUBLE) AS prediction FROM lda""",
)
def plane_discriminant(spark, sf_dir):
    """Discriminant of one category on the unit square, fitted on all rows."""
    return rounded(linear_discriminant(plane_points(spark, sf_dir), [PLOTTED], None))


@query(
    "score_histogram",
    f"""WITH {SQL_PLANE_LDA}, r AS (SELECT min(score) AS lo, max(score) AS hi FROM lda)
        SELECT label, CAST(least(floor((score - lo) * 10 / (hi - lo)), 9) AS INTEGER) AS bin,
               count(*) AS n FROM lda, r GROUP BY ALL""",
)
def score_histogram(spark, sf_dir):
    scores = linear_discriminant(plane_points(spark, sf_dir), [PLOTTED], None)
    return metrics.score_histogram(materialize(scores, "scores"))


SQL_GRID = f"""{SQL_RESUBSTITUTION}, box AS (
    SELECT min(v) FILTER (WHERE dim = 0) - 1 AS x0, max(v) FILTER (WHERE dim = 0) + 1 AS x1,
           min(v) FILTER (WHERE dim = 1) - 1 AS y0, max(v) FILTER (WHERE dim = 1) + 1 AS y1 FROM plane),
mesh AS (
    SELECT ix, iy, x0 + ix * 0.02 AS x, y0 + iy * 0.02 AS y
    FROM box, (SELECT unnest(range(0, CAST(ceil((x1 - x0) / 0.02) AS BIGINT))) AS ix FROM box),
         (SELECT unnest(range(0, CAST(ceil((y1 - y0) / 0.02) AS BIGINT))) AS iy FROM box)),
sides AS (
    SELECT y AS pos, max(n) AS n,
           max(m) FILTER (WHERE dim = 0) AS mx, max(s) FILTER (WHERE dim = 0) AS sx,
           max(m) FILTER (WHERE dim = 1) AS my, max(s) FILTER (WHERE dim = 1) AS sy
    FROM gnb_stats WHERE category_idx = 0 GROUP BY y),
field AS (
    SELECT ix, iy, pos, ln(n) - 0.5 * (ln(sx) + (x - mx) ** 2 / sx + ln(sy) + (y - my) ** 2 / sy) AS jll
    FROM mesh, sides)
SELECT CAST(ix AS INTEGER) AS ix, CAST(iy AS INTEGER) AS iy,
       CAST(max(jll) FILTER (WHERE pos) > max(jll) FILTER (WHERE NOT pos) AS DOUBLE) AS prediction
FROM field GROUP BY ix, iy"""


@query("decision_grid", f"WITH {SQL_GRID}")
def decision_grid(spark, sf_dir):
    """Gaussian naive Bayes for one category over the mesh of the plane."""
    plane = materialize(plane_points(spark, sf_dir), "plane")
    mesh = plotdata.decision_grid(plane).select(
        F.struct("ix", "iy").alias("doc_id"),
        "features",
        F.array().cast("array<string>").alias("categories"),
        F.lit(1).alias("fold"),
    )
    rows = plane.select(
        F.struct(F.lit(-1).alias("ix"), F.lit(-1).alias("iy")).alias("doc_id"),
        "features",
        "categories",
        F.lit(0).alias("fold"),
    )
    scored = gaussian_nb(rows.unionByName(mesh), [PLOTTED], 1)
    return scored.select("doc_id.ix", "doc_id.iy", "prediction")
