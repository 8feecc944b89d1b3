"""Joint optimiser, all-fold statistics and the area under the curve."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from presswork.learners import crossfold, estimators, joint
from presswork.learners.bayes import gaussian_nb
from presswork.learners.relevance import fit_per_category
from presswork.operators import bags
from presswork.operators.folds import assign_folds
from presswork.operators.metrics import area_under_curve
from presswork.plans import learn_queries
from presswork.session import materialize
from presswork.sources import tables

NAMES = ["a", "b", "c", "absent"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(240):
        x = rng.normal(size=4)
        own = [n for n, w in zip("abc", rng.normal(size=(3, 4)) * 0.2 + np.eye(3, 4)) if x @ w + 0.4 * rng.normal() > 0.3]
        rows.append((i, i % 5, [float(v) for v in x], own))
    df = spark.createDataFrame(rows, "doc_id bigint, fold int, features array<double>, categories array<string>")
    return df.withColumn("features", array_to_vector("features")).cache()


def test_joint_weights_equal_the_single_fits(data):
    train = data.where("fold <> 2")
    weights, jobs = joint.joint_weights(train, NAMES[:3])
    models = fit_per_category(estimators.logistic_regression, data, NAMES[:3], 2)
    for own, model in zip(weights, models):
        assert own[:-1] == pytest.approx(model.coefficients.toArray(), abs=2e-3)
        assert own[-1] == pytest.approx(model.intercept, abs=2e-3)
    # The gradient at the solution, by NumPy.
    rows = train.collect()
    x = np.array([r["features"].toArray() for r in rows])
    for name, w in zip(NAMES, weights):
        y = np.array([name in r["categories"] for r in rows], float)
        p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
        gradient = np.append(x.T @ (p - y) + w[:-1], (p - y).sum()) / len(rows)
        assert np.abs(gradient).max() < 1e-5
    # More categories cost no more jobs than the slowest of them.
    alone = [joint.joint_weights(train, [n])[1] for n in NAMES[:3]]
    assert jobs == max(alone)


def test_gaussian_folds_equal_single_folds(data):
    got = {(r["doc_id"], r["category_idx"]): r for r in crossfold.gaussian_nb_folds(data, NAMES).collect()}
    assert len(got) == 240 * len(NAMES)
    for fold in range(5):
        for row in gaussian_nb(data, NAMES, fold).collect():
            own = got[row["doc_id"], row["category_idx"]]
            assert own["fold"] == fold and own["label"] == row["label"]
            assert own["score"] == pytest.approx(row["score"], rel=1e-6, abs=1e-6)


def test_gaussian_of_one_fold_has_nothing_to_learn_from(data):
    assert crossfold.gaussian_nb_folds(data.where("fold = 1"), NAMES).count() == 0


def test_area_under_curve(spark):
    rnd = random.Random(4)
    rows = [(c, float(rnd.randrange(2)), rnd.choice([rnd.random(), 0.25, 0.5])) for c in range(3) for _ in range(120)]
    rows += [(7, 1.0, 0.5), (7, 1.0, 0.1), (8, 0.0, 0.3)]
    frame = spark.createDataFrame(rows, "category_idx int, label double, score double").repartition(5)
    got = {r["category_idx"]: r for r in area_under_curve(frame).collect()}
    for c in range(3):
        pos = [s for k, y, s in rows if k == c and y]
        neg = [s for k, y, s in rows if k == c and not y]
        won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert got[c]["auc"] == pytest.approx(won / len(pos) / len(neg))
        assert (got[c]["positives"], got[c]["negatives"]) == (len(pos), len(neg))
    assert got[7]["auc"] is None and got[8]["auc"] is None
    assert area_under_curve(frame.where(F.lit(False))).collect() == []


def folds_query(spark, folder):
    """``(doc_id, category_idx) -> scores`` of the query over twelve texts; one id comes twice, with two languages."""
    rows = [(i, f"{'red green' if i % 2 else 'blue grey'} apples pear{chr(97 + i % 3)} kiwi", "en" if i % 2 else "fr", "web") for i in range(10)]
    rows += [(3, "red stones", "fr", "web"), (20, None, "en", "web"), (None, "red blue", "en", "web")]
    folder = str(folder)
    spark.createDataFrame(rows * 2, "doc_id bigint, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    return learn_queries.multinomial_folds(spark, folder)


def test_multinomial_folds_count_repeated_ids_as_a_join_does(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(learn_queries, "MIN_CF", 2)
    found = folds_query(spark, tmp_path)
    docs = assign_folds(tables.docs(spark, str(tmp_path))).select("doc_id", "categories", "fold").collect()
    long = bags.long_bags(bags.wide_bags(tables.docs(spark, str(tmp_path)))).collect()
    df, cf = Counter(r["term"] for r in long), Counter()
    for r in long:
        cf[r["term"]] += r["tf"]
    terms = {t for t, n in cf.items() if n >= 2}
    # Every word of a document meets each row of the same id, when it is weighted and again when it is summed.
    weights = [
        (d["doc_id"], d["fold"], r["term"], r["tf"] / r["doc_len"] * math.log(len(docs) / df[r["term"]]))
        for r in long for d in docs if r["doc_id"] is not None and r["doc_id"] == d["doc_id"] and r["term"] in terms
    ]
    want = Counter()
    for d in docs:
        for i, name in enumerate(("en", "fr")):
            rest = [x for x in docs if x["fold"] != d["fold"]]
            inside = sum(name in x["categories"] for x in rest)
            mass = [Counter(), Counter()]
            for key, fold, term, w in weights:
                for x in docs:
                    if x["doc_id"] == key and fold != d["fold"]:
                        mass[name in x["categories"]][term] += w
            score = math.log(inside) - math.log(len(rest) - inside)
            for key, _, term, w in weights:
                if key == d["doc_id"]:
                    p, q = ((m[term] + 1) / (sum(m.values()) + len(terms)) for m in (mass[1], mass[0]))
                    score += w * (math.log(p) - math.log(q))
            want[d["doc_id"], i, round(score, 4) + 0.0] += 1
    assert Counter((r["doc_id"], r["category_idx"], round(r["score"], 4) + 0.0) for r in found.collect()) == want


def test_multinomial_folds_join_no_words_with_documents_and_sort_none(spark, tmp_path, monkeypatch):
    """At full size the table of documents is too large to broadcast: the words carry what they need of it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = []
        monkeypatch.setattr(learn_queries, "materialize", lambda df, label: asked.append((label, df)) or materialize(df, label))
        plan = folds_query(spark, tmp_path)._jdf.queryExecution().executedPlan().toString()
        weighted = dict(asked)["weights"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert weighted.count("SortMergeJoin") == 1  # the words with the dictionary
    assert "ShuffledHashJoin [term_idx" in plan
