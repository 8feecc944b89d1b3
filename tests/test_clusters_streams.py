import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from presswork.clustering.affinity import _exemplars, affinity_propagation, spectral_clustering
from presswork.clustering.centroids import birch, kmeans
from presswork.clustering.report import cluster_report
from presswork.operators import bags, plotdata
from presswork.operators.neighbors import points_of
from presswork.session import build_session  # noqa: F401
from presswork.streaming import incremental


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(4)
    centers = np.array([[0, 0], [6, 0], [0, 6]], dtype=float)
    x = np.concatenate([c + 0.2 * rng.normal(size=(30, 2)) for c in centers])
    rows = [(i, [float(a) for a in v], i // 30) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "doc_id bigint, features array<double>, truth int")
    return df.withColumn("features", array_to_vector("features")).cache()


@pytest.mark.parametrize(
    "run",
    [
        lambda d: kmeans(d, 3, "random", starts=4),
        lambda d: kmeans(d, 3, "k-means||", starts=2),
        lambda d: birch(d, 3),
        lambda d: spectral_clustering(points_of(d), 3, neighbors=8),
        lambda d: affinity_propagation(points_of(d), damping=0.7, preference=-20.0, neighbors=29, max_iter=25),
    ],
    ids=["kmeans", "kmeans||", "birch", "spectral", "affinity"],
)
def test_clusterings_find_the_blobs(blobs, run):
    row = cluster_report(run(blobs), blobs.select("doc_id", "truth"), "m", 1.0).first()
    assert row["ami"] > 0.95 and row["nmi"] > 0.95


def test_points_that_know_no_exemplar_join_the_nearest(spark):
    points = spark.createDataFrame([(i, [float(i)]) for i in range(7)], "id bigint, vec array<double>")
    pairs = [(i, i, -9.0) for i in range(7)] + [(1, 0, -1.0), (2, 1, -1.0), (4, 3, -1.0), (5, 6, -1.0)]
    rows = [(i, j, s, 1.0 if i == j and i in (0, 6) else -1.0, 0.0) for i, j, s in pairs]
    state = spark.createDataFrame(rows, "id bigint, neighbor bigint, s double, r double, a double")
    got = {r["doc_id"]: r["cluster"] for r in _exemplars(state, points).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1}


def test_affinity_without_exemplar_is_told(spark):
    points = spark.createDataFrame([(i, [float(i)]) for i in range(6)], "id bigint, vec array<double>")
    with pytest.warns(UserWarning, match="did not settle"):
        got = affinity_propagation(points, preference=-1e9, neighbors=2, max_iter=1)
    assert got.count() == 6


def test_decision_grid_covers_the_margin(blobs):
    grid = plotdata.decision_grid(blobs, step=0.5)
    stats = blobs.select(F.expr("1")).count()
    assert stats == 90
    first = grid.where("ix = 0 and iy = 0").first()["features"]
    low = np.array([r["features"].toArray() for r in blobs.collect()]).min(0) - 1
    np.testing.assert_allclose(first.toArray(), low)
    assert grid.count() == grid.select("ix", "iy").distinct().count()


def test_stream_word_counts_equal_batch(spark, tmp_path):
    rows = [(str(i), f"apple pear{'s' * (i % 2)} word{chr(97 + i % 5)}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id string, full_text string")
    df.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    got = incremental.run_to_table(incremental.stream_word_counts(stream))
    batch = bags.word_dictionary(bags.long_bags(bags.wide_bags(df)))
    assert sorted(got.collect()) == sorted(batch.select(got.columns).collect())


def test_streams_go_on_in_their_folder(spark, tmp_path):
    words = spark.createDataFrame([("1", "apple"), ("2", "apple pear")], "doc_id string, full_text string")
    rows = spark.createDataFrame(
        [("1", [0, 1], [1.0, 2.0]), ("2", [1, 2], [3.0, 1.0])],
        "doc_id string, indices array<int>, weights array<double>",
    )

    def counts(folder):
        stream = spark.readStream.schema(words.schema).parquet(str(tmp_path / "words"))
        found = incremental.run_to_table(incremental.stream_word_counts(stream), folder=str(tmp_path / folder))
        return sorted((r["term"], r["df"]) for r in found.collect())

    def sketch(folder):
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "rows"))
        found = incremental.run_stream_pca(stream, 3, 2, folder=str(tmp_path / folder))
        return {r["term_idx"]: np.round(r["v"], 9).tolist() for r in found.collect()}

    for doc_id in ("1", "2"):
        words.where(F.col("doc_id") == doc_id).write.mode("append").parquet(str(tmp_path / "words"))
        rows.where(F.col("doc_id") == doc_id).write.mode("append").parquet(str(tmp_path / "rows"))
        seen = counts("a"), sketch("b")
    assert seen[0] == [("apple", 2), ("pear", 1)]
    # Without new files the state of the last run is told again; one run over all files agrees.
    assert (counts("a"), sketch("b")) == seen
    assert (counts("c"), sketch("d")) == seen


def test_replayed_documents_are_dropped(spark, tmp_path):
    df = spark.createDataFrame([("1", "apple")] * 3, "doc_id string, full_text string")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    got = incremental.run_to_table(
        incremental.stream_word_counts(incremental.unique_docs(stream))
    )
    assert [(r["term"], r["df"]) for r in got.collect()] == [("apple", 1)]


def test_preprocess_with_lexicon_and_stems(spark, tmp_path):
    from presswork.plans import flows

    rows = [
        ("1", ["a", "b"], "Cats chase unknownword cats"),
        ("2", ["a"], "dogs chase"),
        ("3", ["a"], "unknownword"),
    ]
    docs = spark.createDataFrame(rows, "doc_id string, categories array<string>, full_text string")
    lexicon = spark.createDataFrame([(w,) for w in ("Cats", "cats", "chase", "dogs")], "word string")
    stems = bags.stem_table(lexicon.select(F.lower("word").alias("word")))
    stages = flows.preprocess(
        docs, str(tmp_path / "s"), min_category=2, min_cf=1, n_folds=2, lexicon=lexicon, stems=stems
    )
    got = {r["doc_id"]: r for r in stages.rows.collect()}
    assert sorted(got) == ["1", "2", "3"] and got["3"]["indices"] == []
    assert [r["category"] for r in stages.categories.where("selected").collect()] == ["a"]
    np.testing.assert_allclose(
        got["1"]["weights"], [2 / 3 * np.log(3 / 1), 1 / 3 * np.log(3 / 2)]
    )


def test_a_batch_of_the_pca_stream_writes_its_own_sketch_only(spark, tmp_path):
    """Each batch used to read and write again all terms of the batches before it."""
    rows = spark.createDataFrame(
        [("1", [0, 1], [1.0, 2.0]), ("2", [2], [3.0])], "doc_id string, indices array<int>, weights array<double>"
    )
    for doc_id in ("1", "2"):
        rows.where(F.col("doc_id") == doc_id).coalesce(1).write.mode("append").parquet(str(tmp_path / "rows"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "rows"))
        whole = incremental.run_stream_pca(stream, 3, 2, folder=str(tmp_path / "b"))
    assert sorted(r["term_idx"] for r in whole.collect()) == [0, 1, 2]
    last = spark.read.parquet(incremental._batch_path(str(tmp_path / "b" / "state"), 1))
    assert [r["term_idx"] for r in last.collect()] == [2]


def test_a_batch_of_the_bayes_stream_writes_its_own_sums_only(spark, tmp_path, monkeypatch):
    """Each batch used to hold and write again the sums of all batches before it."""
    schema = "doc_id string, categories array<string>, indices array<int>, weights array<double>"
    rows = spark.createDataFrame(
        [("1", ["a", None], [0, 1], [1.0, 2.0]), ("2", ["b", "a"], [1, 2], [3.0, 0.0]), ("3", [None], [], [])], schema
    )
    for doc_id in ("1", "2", "3"):
        rows.where(F.col("doc_id") == doc_id).coalesce(1).write.mode("append").parquet(str(tmp_path / "rows"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "rows"))
        whole = incremental.run_stream_multinomial_nb(stream, ["a", "b"], str(tmp_path / "nb"))
    expected = {(0, 1, 0, 1.0), (0, 1, 1, 5.0), (0, 1, 2, 0.0), (1, None, 0, 1.0), (1, None, 1, 2.0), (1, 1, 1, 3.0), (1, 1, 2, 0.0)}
    assert {tuple(r) for r in whole.collect()} == expected
    last = spark.read.parquet(incremental._batch_path(str(tmp_path / "nb" / "out"), 1)).collect()
    assert {(r["category_idx"], r["label"], r["term_idx"], r["weight"]) for r in last} == {
        (0, 1, 1, 3.0), (0, 1, 2, 0.0), (1, 1, 1, 3.0), (1, 1, 2, 0.0)
    }
    monkeypatch.setattr(incremental, "MAX_COLUMNS", 1)
    assert {tuple(r) for r in incremental.stream_multinomial_nb(rows, ["a", "b"]).collect()} == expected
