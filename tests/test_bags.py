import math
from collections import Counter

from pyspark.sql import functions as F

from presswork.functions import text as tx
from presswork.operators import bags
from presswork.operators.ranking import dense_index
from presswork.sources import stages

DOCS = [
    ("1", "Cats chase cats and dogs"),
    ("2", "dogs bark"),
    ("3", "the of and 12"),
    ("4", "zebra"),
]


def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id string, full_text string")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bags_keep_empty_documents(spark):
    rows = {r["doc_id"]: r for r in bags.wide_bags(docs(spark)).collect()}
    assert [(t["term"], t["tf"]) for t in rows["1"]["bag"]] == [("cat", 2), ("chase", 1), ("dog", 1)]
    assert rows["1"]["doc_len"] == 4
    assert rows["3"]["bag"] == [] and rows["3"]["doc_len"] == 0


def test_bags_need_no_shuffle(spark):
    assert "Exchange" not in plan_of(bags.long_bags(bags.wide_bags(docs(spark))))


def test_joined_bags_equal_row_bags_when_everything_is_known(spark):
    tokens = bags.token_table(docs(spark))
    lexicon = tokens.select("word").distinct()
    stems = bags.stem_table(lexicon.select(F.lower("word").alias("word")))
    joined = bags.joined_bags(bags.word_counts(docs(spark)), lexicon, stems)
    plain = bags.long_bags(bags.wide_bags(docs(spark)))
    columns = ["doc_id", "term", "tf", "doc_len"]
    assert sorted(joined.select(columns).collect()) == sorted(plain.select(columns).collect())


def test_lexicon_is_case_sensitive(spark):
    lexicon = spark.createDataFrame([("cats",), ("dogs",)], "word string")
    out = bags.joined_bags(bags.word_counts(docs(spark)), lexicon)
    assert sorted((r["doc_id"], r["term"], r["tf"], r["doc_len"]) for r in out.collect()) == [
        ("1", "cats", 1, 2), ("1", "dogs", 1, 2), ("2", "dogs", 1, 1),
    ]


def test_dictionary_threshold_is_on_collection_count(spark):
    long = bags.long_bags(bags.wide_bags(docs(spark)))
    found = {r["term"]: (r["df"], r["cf"]) for r in bags.word_dictionary(long, 2).collect()}
    assert found == {"cat": (1, 2), "dog": (2, 2)}


def test_tfidf_formula_and_full_length(spark):
    long = bags.long_bags(bags.wide_bags(docs(spark)))
    dictionary = bags.term_index(bags.word_dictionary(long, 2))
    got = {(r["doc_id"], r["term_idx"]): r["weight"] for r in bags.tfidf(long, dictionary, docs(spark)).collect()}
    assert math.isclose(got[("1", 0)], 2 / 4 * math.log(4 / 1))
    assert math.isclose(got[("1", 1)], 1 / 4 * math.log(4 / 2))
    assert math.isclose(got[("2", 1)], 1 / 2 * math.log(4 / 2))
    assert len(got) == 3


def test_idf_is_zero_when_every_document_has_the_term(spark):
    same = spark.createDataFrame([("1", "apple"), ("2", "apple")], "doc_id string, full_text string")
    long = bags.long_bags(bags.wide_bags(same))
    dictionary = bags.term_index(bags.word_dictionary(long))
    assert [r["weight"] for r in bags.tfidf(long, dictionary, same).collect()] == [0.0, 0.0]


def test_dense_index_over_many_partitions(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("k")).repartition(7)
    rows = dense_index(df, [F.col("k")], "pos").collect()
    by_pos = [r["k"] for r in sorted(rows, key=lambda r: r["pos"])]
    assert by_pos == sorted(by_pos) and sorted(r["pos"] for r in rows) == list(range(1000))


def test_sample_and_limit(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("doc_id"))
    first = {r["doc_id"] for r in stages.sample_docs(df, 20).collect()}
    assert len(first) == 20
    assert first == {r["doc_id"] for r in stages.sample_docs(df.repartition(5), 20).collect()}
    kept = [r["doc_id"] for r in stages.limit_docs(df, 3).collect()]
    assert sorted(kept) == ["0", "1", "10"]


def test_bucketed_stage_groups_without_shuffle(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("doc_id"), "id")
    try:
        stages.write_stage_table(df, "stage_a", 4)
        plan = plan_of(spark.table("stage_a").groupBy("doc_id").count())
        assert "Exchange" not in plan
    finally:
        spark.sql("DROP TABLE IF EXISTS stage_a")


def test_hot_word_counts(spark):
    rows = [(str(i), "Hot " * 50 + f"rare{chr(97 + i % 26)}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id string, full_text string")
    long = bags.long_bags(bags.wide_bags(df))
    found = {r["term"]: (r["df"], r["cf"]) for r in bags.word_dictionary(long).collect()}
    assert found["hot"] == (300, 15000)
    assert sum(v[1] for v in found.values()) == sum(Counter(" ".join(t for _, t in rows).split()).values())


def test_the_lexicon_queries_cut_each_text_once(spark, tmp_path, monkeypatch):
    """The lexicon and what it filters share one pass over the texts."""
    from presswork.functions import text as tx
    from presswork.plans import text_queries

    texts = ["Red apples fall", "Red apples rot", "Red apples stay", "one pear", None, ""]
    rows = [(i, t, "en", "web") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    cuts, tokens = [], tx.tokens
    monkeypatch.setattr(tx, "tokens", lambda text: cuts.append(text) or tokens(text))
    found = text_queries.lexicon_filter(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["word"], r["n"]) for r in found} == {(str(i), w, 1) for i in range(3) for w in ("Red", "apples")}
    assert len(cuts) == 1
    bag = text_queries.bag_with_lexicon(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["term"], r["tf"], r["doc_len"]) for r in bag} == {(str(i), w, 1, 2) for i in range(3) for w in ("red", "apple")}
    assert len(cuts) == 2


def test_row_bags_equal_the_expressions(spark):
    """Words are looked up in a task's table; the rules stay those of the column expressions."""
    texts = [
        "Ponies, pennies & EIES: the cats' glasses; bus bees shoes 3-D 2nd", "cannot Gimme gonna gotta lemme WANNA gonnas can-not",
        "caf\u00e9 \ufb01sh \u2116 na\u00efve \u00bd \ud55c\u00a0word\x85other", "gimme\x1fgimmes gonna\x00dogs cannot\x1cstay\x0bstop\x0cend\r\nlast", "", None, "a an of",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id int, full_text string")
    for stopwords in (None, (), ("gim", "dog")):
        for stem, column in ((tx.plural_stem, lambda w: tx.plural_stem(w)), (None, lambda w: w)):
            found = bags.wide_bags(df, stopwords=stopwords, stem=stem)
            assert "ArrowEvalPython" in plan_of(found)
            assert sorted(found.collect(), key=str) == sorted(bags.wide_bags(df, stopwords=stopwords, stem=column).collect(), key=str)


def test_full_table_of_terms_starts_anew():
    small = tx._Terms((), True)
    small.LIMIT = 4
    words = [b"cats", b"dog", b"a\x1fb", b"red\x1fcannot", b"cats", b"birds", b"red\x1fcannot"]
    want = {"cat": 2, "dog": 1, "red\x1fcan": 2, "not": 2, "bird": 1, "a\x1fb": 1}
    assert [dict(small.counts(words)) for _ in range(3)] == [want] * 3
    assert len(small) <= 4 + len(set(words))
