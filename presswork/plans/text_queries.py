"""Queries over articles, words and categories, each with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from presswork.functions import text as tx
from presswork.functions.maths import hash_key
from presswork.operators import bags, categories, folds
from presswork.plans import sql_parts as sp
from presswork.session import materialize, scratch_path
from presswork.sources import articles, stages, tables

MIN_CF = 10
MIN_CATEGORY = 100
LEXICON_DF = 3

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


# ------------------------------------------------------------------- articles

# Characters that XML 1.0 does not allow.
ILLEGAL = r"[\x00-\x08\x0B\x0C\x0E-\x1F￾￿]"
SQL_CLEAN = r"regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFE}\x{FFFF}]', '', 'g')"
SQL_SECTIONS = "concat(source, '; ', lang, ' and ', lang, '(', source, ')')"


def sections(source="source", lang="lang"):
    s, c = F.col(source), F.col(lang)
    return F.concat(s, F.lit("; "), c, F.lit(" and "), c, F.lit("("), s, F.lit(")"))


def nitf_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an NITF string: one paragraph per line, a repeated lead,
    a nested element, an unused block and two ids."""
    clean = F.regexp_replace("text", ILLEGAL, "")
    escaped = F.replace(
        F.replace(F.replace(clean, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
        F.lit(">"),
        F.lit("&gt;"),
    )
    paragraphs = F.concat(
        F.lit("<p>"), F.replace(escaped, F.lit("\n"), F.lit("</p><p>")), F.lit("</p>")
    )

    def meta(name, value):
        return [F.lit('<meta content="'), value, F.lit(f'" name="{name}"/>')]

    day = (F.col("doc_id").cast("bigint") % 28 + 1).cast("string")
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE nitf SYSTEM "nitf.dtd">\n'),
        F.lit("<nitf><head><title>Item "),
        F.col("doc_id"),
        F.lit("</title>"),
        *meta("slug", F.lit("s")),
        *meta("publication_day_of_month", day),
        *meta("publication_month", F.lit("11")),
        *meta("publication_year", F.lit("2006")),
        *meta("online_sections", sections()),
        F.lit('<docdata><doc-id id-string="first"/><doc-id id-string="'),
        F.col("doc_id"),
        F.lit('"/><identified-content><location class="a">'),
        F.col("source"),
        F.lit("</location><location>"),
        F.col("lang"),
        F.lit("</location></identified-content></docdata></head><body><body.content>"),
        F.lit('<block class="lead_paragraph"><p>unused</p></block><block class="full_text">'),
        paragraphs,
        F.lit("<p>LEAD: said before</p></block>"),
        F.lit('<block class="full_text"><p>shown <em>cut</em> cut</p><p/></block>'),
        F.lit("</body.content></body></nitf>"),
    )
    return tables.documents(spark, sf_dir).select("doc_id", "lang", "source", xml.alias("xml"))


# Paragraphs are trimmed by the XML reader and end at something tag-like.
_TRIMMED = rf"regexp_replace({SQL_CLEAN}, '[ \t\r]*\n[ \t\r]*', chr(10), 'g')"
_TRIMMED = rf"regexp_replace({_TRIMMED}, '^[ \t\r]+|[ \t\r]+$', '', 'g')"
_CUT = rf"regexp_replace({_TRIMMED}, '<[A-Za-z][^\n]*', '', 'g')"
SQL_FULL_TEXT = f"concat(chr(10), {sp.fold(_CUT)}, chr(10), 'shown ', chr(10))"
SQL_CATEGORIES = "concat_ws('|', source, lang, lang, source)"


@query(
    "parse_articles",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, {SQL_CATEGORIES} AS categories,
        {SQL_FULL_TEXT} AS full_text FROM documents""",
)
def parse_articles(spark, sf_dir):
    parsed = articles.parse_articles(nitf_text(spark, sf_dir).select("xml"), "xml")
    return articles.to_docs(parsed).withColumn("categories", F.array_join("categories", "|"))


@query(
    "read_articles",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, {SQL_CATEGORIES} AS categories,
        {SQL_FULL_TEXT} AS full_text FROM documents""",
)
def read_articles(spark, sf_dir):
    """Articles written as XML files and read back from the folder."""
    path = scratch_path(spark, "articles")
    source = articles.parse_articles(nitf_text(spark, sf_dir).select("xml"), "xml")
    articles.write_articles(source, path)
    docs = articles.to_docs(articles.read_articles(spark, path))
    return docs.withColumn("categories", F.array_join("categories", "|"))


@query("article_doc_id", "SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM documents")
def article_doc_id(spark, sf_dir):
    parsed = articles.parse_articles(nitf_text(spark, sf_dir).select("xml"), "xml")
    return parsed.select(articles.article_doc_id().alias("doc_id"))


@query(
    "article_full_text",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5({SQL_FULL_TEXT}) AS digest,
        CAST(length({SQL_FULL_TEXT}) AS INTEGER) AS n_chars FROM documents""",
)
def article_full_text(spark, sf_dir):
    parsed = articles.parse_articles(nitf_text(spark, sf_dir).select("doc_id", "xml"), "xml")
    body = parsed.select("doc_id", articles.article_full_text().alias("t"))
    return body.select("doc_id", F.md5("t").alias("digest"), F.length("t").alias("n_chars"))


@query(
    "article_metadata",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, concat('Item ', doc_id) AS title,
        concat(source, '|', lang) AS locations, CAST(doc_id % 28 + 1 AS VARCHAR) AS day,
        '11' AS month, '2006' AS year, {SQL_SECTIONS} AS online_sections,
        strftime(make_date(2006, 11, CAST(doc_id % 28 + 1 AS INTEGER)), '%Y-%m-%d') AS pub_date
        FROM documents""",
)
def article_metadata(spark, sf_dir):
    parsed = articles.parse_articles(nitf_text(spark, sf_dir).select("xml"), "xml")
    return articles.article_metadata(parsed).withColumns(
        {"locations": F.array_join("locations", "|"), "pub_date": F.col("pub_date").cast("string")}
    )


@query(
    "drop_unusable",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang FROM documents
       WHERE lang <> 'de' AND source <> 'src3'""",
)
def drop_unusable(spark, sf_dir):
    """German texts are blanked and one source loses its categories first."""
    rows = tables.documents(spark, sf_dir).select(
        "doc_id",
        "lang",
        F.when(F.col("source") == "src3", F.array().cast("array<string>"))
        .otherwise(F.array("lang", "source"))
        .alias("categories"),
        F.when(F.col("lang") == "de", "").otherwise(F.col("text")).alias("full_text"),
    )
    return articles.drop_unusable(rows).select("doc_id", "lang")


@query("doc_count", "SELECT count(*) AS n_docs FROM documents WHERE length(text) > 0")
def doc_count(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.array("lang").alias("categories"),
        F.col("text").alias("full_text"),
    )
    return stages.doc_count(articles.drop_unusable(rows))


@query(
    "stage_round_trip",
    f"""WITH {sp.LABELS}, folded AS ({sp.fold_of('labelled')})
        SELECT fold, doc_id, array_to_string(categories, '|') AS categories
        FROM folded WHERE fold = 2""",
)
def stage_round_trip(spark, sf_dir):
    """Labels written by fold; one fold read back touches one folder."""
    path = scratch_path(spark, "labels")
    stages.write_stage(folds.assign_folds(tables.labels(spark, sf_dir)), path, "fold")
    stored = stages.read_stage(spark, path, "doc_id string, categories array<string>, fold int")
    return stored.where("fold = 2").select(
        "fold", "doc_id", F.array_join("categories", "|").alias("categories")
    )


@query(
    "sample_docs",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, length(text) AS n_chars FROM documents
       ORDER BY md5(concat(doc_id, ':42')) LIMIT 100""",
)
def sample_docs(spark, sf_dir):
    picked = stages.sample_docs(tables.documents(spark, sf_dir), 100)
    return picked.select("doc_id", "lang", F.length("text").cast("bigint").alias("n_chars"))


@query(
    "sample_bags",
    f"""WITH {sp.bags()}, picked AS (
            SELECT doc_id FROM docs ORDER BY md5(concat(doc_id, ':42')) LIMIT 10)
        SELECT doc_id, term, tf FROM bags SEMI JOIN picked USING (doc_id)""",
)
def sample_bags(spark, sf_dir):
    """Ten documents drawn first, so only their texts are tokenised."""
    picked = stages.sample_docs(tables.docs(spark, sf_dir), 10)
    return bags.long_bags(bags.wide_bags(picked)).drop("doc_len")


@query(
    "limit_docs",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang FROM documents
       ORDER BY CAST(doc_id AS VARCHAR) LIMIT 100""",
)
def limit_docs(spark, sf_dir):
    return stages.limit_docs(tables.documents(spark, sf_dir), 100).select("doc_id", "lang")


# -------------------------------------------------------------------- strings


@query(
    "parse_categories",
    f"""WITH s AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, {SQL_SECTIONS} AS raw FROM documents),
        parts AS (SELECT doc_id, unnest(string_split_regex(
            regexp_replace(raw, '[()]', ', ', 'g'), ';|and|,')) AS p FROM s)
        SELECT doc_id, lower(trim(p)) AS category, count(*) AS n FROM parts
        WHERE trim(p) <> '' GROUP BY ALL""",
)
def parse_categories(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.explode(tx.split_sections(sections())).alias("category"),
    )
    return rows.groupBy("doc_id", "category").agg(F.count("*").alias("n"))


@query(
    "fold_ascii",
    f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5({sp.fold('text')}) AS digest FROM documents",
)
def fold_ascii(spark, sf_dir):
    return tables.documents(spark, sf_dir).select(
        "doc_id", F.md5(tx.fold_ascii(F.col("text"))).alias("digest")
    )


@query(
    "strip_punct_digits",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5({sp.strip(sp.fold('text'))}) AS digest
        FROM documents""",
)
def strip_punct_digits(spark, sf_dir):
    text = tx.strip_punct_digits(tx.fold_ascii(F.col("text")))
    return tables.documents(spark, sf_dir).select("doc_id", F.md5(text).alias("digest"))


@query(
    "tokenize",
    f"""WITH {sp.tokens()} SELECT word, count(*) AS n, count(DISTINCT doc_id) AS n_docs
        FROM tokens GROUP BY word""",
)
def tokenize(spark, sf_dir):
    """Words as written; counted inside each document before any shuffle."""
    counted = tables.docs(spark, sf_dir).select(
        F.inline_outer(tx.count_words(tx.tokens(F.col("full_text"))))
    )
    return (
        counted.where(F.col("term").isNotNull())
        .groupBy(F.col("term").alias("word"))
        .agg(F.sum("tf").alias("n"), F.count("*").alias("n_docs"))
    )


@query("sentences")
def sentences(spark, sf_dir):
    return tables.documents(spark, sf_dir).select(
        "doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("position", "sentence")
    )


# ------------------------------------------------------------ lexicon and stems


def stored_words(spark, sf_dir) -> DataFrame:
    """The words of each document, read by the lexicon and again by what it filters: cut once."""
    docs = tables.docs(spark, sf_dir)
    return materialize(docs.select("doc_id", tx.tokens(F.col("full_text")).alias("words")), "words")


def lexicon(cut: DataFrame) -> DataFrame:
    """Stand-in lexicon: words as written in at least three documents."""
    met = cut.select(F.explode(F.array_distinct("words")).alias("word"))
    totals = met.groupBy("word").agg(F.count("*").alias("n_docs"))
    return materialize(totals.where(F.col("n_docs") >= LEXICON_DF).select("word"), "lexicon")


SQL_LEXICON = f"""lexicon AS (
    SELECT word FROM tokens GROUP BY word HAVING count(DISTINCT doc_id) >= {LEXICON_DF})"""


@query(
    "lexicon_filter",
    f"""WITH {sp.tokens()}, {SQL_LEXICON}
        SELECT doc_id, word, count(*) AS n FROM tokens SEMI JOIN lexicon USING (word)
        GROUP BY doc_id, word""",
)
def lexicon_filter(spark, sf_dir):
    cut = stored_words(spark, sf_dir)
    kept = bags.lexicon_filter(bags.token_table(cut, words="words"), lexicon(cut))
    return kept.groupBy("doc_id", "word").agg(F.count("*").alias("n"))


@query(
    "stopword_filter",
    f"""WITH {sp.tokens()} SELECT lower(word) AS word, count(*) AS n FROM tokens
        WHERE {sp.keep('word')} GROUP BY lower(word)""",
)
def stopword_filter(spark, sf_dir):
    """The anti-join form, with the stopwords as a table."""
    stop = spark.createDataFrame([(w,) for w in tx.default_stopwords()], "word string")
    tokens = bags.token_table(tables.docs(spark, sf_dir))
    return bags.stopword_filter(tokens, stop).groupBy("word").agg(F.count("*").alias("n"))


@query(
    "stem_terms",
    f"""WITH {sp.tokens()}, lowered AS (SELECT lower(word) AS w FROM tokens WHERE {sp.keep('word')})
        SELECT w AS term, {sp.stem('w')} AS stem, count(*) AS n FROM lowered GROUP BY w""",
)
def stem_terms(spark, sf_dir):
    """Stem each distinct word once and join the stems back to the counts."""
    counts = (
        tokenize(spark, sf_dir)
        .where(tx.keep_word(F.col("word"), tx.default_stopwords()))
        .groupBy(F.lower("word").alias("word"))
        .agg(F.sum("n").alias("n"))
    )
    counts = materialize(counts, "words")
    stems = bags.stem_table(counts)
    return counts.join(stems, counts["word"] == stems["term"]).select("term", "stem", "n")


@query(
    "post_stem_filter",
    f"""WITH {sp.bags()} SELECT term, CAST(sum(tf) AS BIGINT) AS n FROM bags GROUP BY term""",
)
def post_stem_filter(spark, sf_dir):
    long = bags.long_bags(bags.wide_bags(tables.docs(spark, sf_dir)))
    return long.groupBy("term").agg(F.sum("tf").alias("n"))


# ----------------------------------------------------------- bags, dictionary


def wide(spark, sf_dir) -> DataFrame:
    return bags.wide_bags(tables.docs(spark, sf_dir))


def stored_bags(spark, sf_dir, docs: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bags are read by the dictionary and again by the weights: written once.

    ``docs`` stands for the table's own rows where these carry further columns, named by ``keep``.
    """
    rows = wide(spark, sf_dir) if docs is None else bags.wide_bags(docs)
    return materialize(bags.long_bags(rows, keep=keep), "bags")


@query("bag_of_words", f"WITH {sp.bags()} SELECT doc_id, term, tf, doc_len FROM bags")
def bag_of_words(spark, sf_dir):
    return bags.long_bags(wide(spark, sf_dir)).select("doc_id", "term", "tf", "doc_len")


@query(
    "bag_per_document",
    f"""WITH {sp.bags()} SELECT docs.doc_id, count(term) AS n_terms,
        coalesce(max(doc_len), 0) AS doc_len,
        coalesce(string_agg(concat(term, '=', tf), ' ' ORDER BY term)
            FILTER (WHERE term IS NOT NULL), '') AS bag
        FROM docs LEFT JOIN bags USING (doc_id) GROUP BY docs.doc_id""",
)
def bag_per_document(spark, sf_dir):
    """The wide form; documents with an empty bag stay."""
    pairs = F.transform("bag", lambda t: F.concat_ws("=", t["term"], t["tf"].cast("string")))
    return wide(spark, sf_dir).select(
        "doc_id",
        F.size("bag").cast("bigint").alias("n_terms"),
        "doc_len",
        F.array_join(pairs, " ").alias("bag"),
    )


@query(
    "bag_with_lexicon",
    f"""WITH {sp.tokens()}, {SQL_LEXICON}, stemmed AS (
            SELECT doc_id, {sp.stem('w')} AS term FROM (
                SELECT doc_id, lower(word) AS w FROM tokens SEMI JOIN lexicon USING (word)
                WHERE {sp.keep('word')}))
        SELECT doc_id, term, count(*) AS tf,
               CAST(sum(count(*)) OVER (PARTITION BY doc_id) AS BIGINT) AS doc_len
        FROM stemmed WHERE {sp.keep('term')} GROUP BY doc_id, term""",
)
def bag_with_lexicon(spark, sf_dir):
    """Lexicon and stems as tables."""
    cut = stored_words(spark, sf_dir)
    words = lexicon(cut)
    lowered = words.select(F.lower("word").alias("word"))
    stems = bags.stem_table(lowered)
    counted = bags.word_counts(cut, words="words")
    return bags.joined_bags(counted, words, stems).select("doc_id", "term", "tf", "doc_len")


@query(
    "word_dictionary",
    f"WITH {sp.dictionary(MIN_CF)} SELECT term, df, cf FROM dictionary",
)
def word_dictionary(spark, sf_dir):
    return bags.word_dictionary(bags.long_bags(wide(spark, sf_dir)), MIN_CF)


@query("term_index", f"WITH {sp.dictionary(MIN_CF)} SELECT term, df, cf, term_idx FROM dictionary")
def term_index(spark, sf_dir):
    return bags.term_index(word_dictionary(spark, sf_dir)).select("term", "df", "cf", "term_idx")


@query(
    "known_words",
    f"""WITH {sp.dictionary(MIN_CF)} SELECT doc_id, term_idx, tf, df
        FROM bags JOIN dictionary USING (term)""",
)
def known_words(spark, sf_dir):
    long = stored_bags(spark, sf_dir)
    dictionary = bags.term_index(bags.word_dictionary(long, MIN_CF))
    return bags.known_words(long, dictionary).select("doc_id", "term_idx", "tf", "df")


@query(
    "doc_length",
    f"WITH {sp.bags()} SELECT doc_id, CAST(sum(tf) AS BIGINT) AS doc_len FROM bags GROUP BY doc_id",
)
def doc_length(spark, sf_dir):
    """The row already knows its length; no grouping is needed."""
    return wide(spark, sf_dir).where("doc_len > 0").select("doc_id", "doc_len")


@query("corpus_size", "SELECT count(DISTINCT doc_id) AS n_docs FROM documents")
def corpus_size(spark, sf_dir):
    return bags.corpus_size(tables.table(spark, sf_dir, "documents"))


def weighted(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(weights, dictionary) of all documents."""
    long = stored_bags(spark, sf_dir)
    dictionary = bags.term_index(bags.word_dictionary(long, MIN_CF))
    everyone = tables.table(spark, sf_dir, "documents")
    return bags.tfidf(long, dictionary, everyone), dictionary


@query(
    "tfidf",
    f"WITH {sp.tfidf(MIN_CF)} SELECT doc_id, term_idx, round(weight, 6) AS weight FROM weights",
)
def tfidf(spark, sf_dir):
    weights, _ = weighted(spark, sf_dir)
    return weights.select("doc_id", "term_idx", F.round("weight", 6).alias("weight"))


@query(
    "top_terms",
    f"""WITH {sp.tfidf(MIN_CF)} SELECT doc_id, CAST(rank AS INTEGER) AS rank, term,
        round(weight, 6) AS weight FROM (
            SELECT *, row_number() OVER (
                PARTITION BY doc_id ORDER BY weight DESC, term_idx) AS rank FROM weights)
        WHERE rank <= 5""",
)
def top_terms(spark, sf_dir):
    weights, dictionary = weighted(spark, sf_dir)
    top = bags.top_terms(weights, dictionary, 5)
    return top.select("doc_id", "rank", "term", F.round("weight", 6).alias("weight"))


# ----------------------------------------------------------------- categories


@query(
    "category_counts",
    f"""WITH {sp.LABELS} SELECT category, count(*) AS n
        FROM (SELECT unnest(categories) AS category FROM labelled) GROUP BY category""",
)
def category_counts(spark, sf_dir):
    return categories.category_counts(tables.labels(spark, sf_dir))


SQL_SELECTED = f"""{sp.LABELS}, counts AS (
    SELECT category, count(*) AS n
    FROM (SELECT unnest(categories) AS category FROM labelled) GROUP BY category),
selected AS (
    SELECT category, n, CAST(row_number() OVER (ORDER BY n DESC, category) - 1 AS INTEGER) AS category_idx
    FROM counts WHERE n >= {MIN_CATEGORY})"""


def selected(spark, sf_dir) -> DataFrame:
    return materialize(
        categories.select_categories(category_counts(spark, sf_dir), MIN_CATEGORY), "categories"
    )


@query(
    "select_categories",
    f"""WITH {SQL_SELECTED} SELECT counts.category, counts.n,
        selected.category IS NOT NULL AS selected, category_idx
        FROM counts LEFT JOIN selected USING (category)""",
)
def select_categories(spark, sf_dir):
    return selected(spark, sf_dir)


@query(
    "has_category",
    f"""WITH {sp.LABELS} SELECT doc_id, CAST(list_contains(categories, 'en') AS DOUBLE) AS label
        FROM labelled""",
)
def has_category(spark, sf_dir):
    return tables.labels(spark, sf_dir).select(
        "doc_id", categories.has_category("en").alias("label")
    )


@query(
    "doc_category_index",
    f"""WITH {SQL_SELECTED} SELECT DISTINCT doc_id, category_idx FROM (
            SELECT doc_id, unnest(categories) AS category FROM labelled)
        JOIN selected USING (category)""",
)
def doc_category_index(spark, sf_dir):
    return categories.doc_category_index(tables.labels(spark, sf_dir), selected(spark, sf_dir))


@query(
    "label_matrix",
    f"""WITH {SQL_SELECTED} SELECT doc_id, category_idx,
        CAST(list_contains(categories, category) AS DOUBLE) AS label FROM labelled, selected""",
)
def label_matrix(spark, sf_dir):
    names = categories.selected_names(selected(spark, sf_dir))
    return categories.label_matrix(tables.labels(spark, sf_dir), names)


@query(
    "label_support",
    f"""WITH {SQL_SELECTED}, folded AS ({sp.fold_of('labelled')})
        SELECT category_idx, CAST(sum(CAST(list_contains(categories, category) AS INTEGER)) AS BIGINT)
            AS support
        FROM folded, selected WHERE fold = 2 GROUP BY category_idx""",
)
def label_support(spark, sf_dir):
    names = categories.selected_names(selected(spark, sf_dir))
    test = folds.held_out_fold(folds.assign_folds(tables.labels(spark, sf_dir)), 2)
    return categories.label_support(categories.label_matrix(test, names))


SQL_TRUTH = f"""{SQL_SELECTED}, positions AS (
    SELECT doc_id, unnest(categories) AS category, generate_subscripts(categories, 1) - 1 AS pos
    FROM labelled),
drawn AS (
    SELECT doc_id, category FROM positions QUALIFY row_number() OVER (PARTITION BY doc_id
        ORDER BY md5(concat_ws(':', doc_id, category, pos, '42'))) = 1),
truths AS (
    SELECT doc_id, coalesce(category_idx, (SELECT CAST(count(*) AS INTEGER) FROM selected)) AS truth
    FROM drawn LEFT JOIN selected USING (category))"""


@query("single_label", f"WITH {SQL_TRUTH} SELECT doc_id, truth FROM truths")
def single_label(spark, sf_dir):
    return categories.single_label(tables.labels(spark, sf_dir), selected(spark, sf_dir))


# ---------------------------------------------------------------------- folds


@query(
    "assign_folds",
    f"""WITH {sp.DOCS}, folded AS ({sp.fold_of('docs')}) SELECT doc_id, fold FROM folded""",
)
def assign_folds(spark, sf_dir):
    rows = tables.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id")
    )
    return folds.assign_folds(rows)


@query(
    "train_test_by_fold",
    f"""WITH {sp.DOCS}, folded AS ({sp.fold_of('docs')})
        SELECT CASE WHEN fold = 2 THEN 'test' ELSE 'train' END AS part, doc_id FROM folded""",
)
def train_test_by_fold(spark, sf_dir):
    folded = assign_folds(spark, sf_dir)
    train = folds.train_folds(folded, 2).select(F.lit("train").alias("part"), "doc_id")
    return train.unionByName(
        folds.held_out_fold(folded, 2).select(F.lit("test").alias("part"), "doc_id")
    )


@query(
    "union_folds",
    f"""WITH {sp.DOCS}, folded AS ({sp.fold_of('docs')})
        SELECT fold, count(*) AS n FROM folded GROUP BY fold""",
)
def union_folds(spark, sf_dir):
    folded = assign_folds(spark, sf_dir)
    parts = [folded.where(F.col("fold") == i) for i in range(10)]
    return folds.union_folds(*parts).groupBy("fold").agg(F.count("*").alias("n"))


@query(
    "attach_labels",
    f"""WITH {sp.tfidf(MIN_CF)}, {sp.LABELS}, folded AS ({sp.fold_of('labelled')})
        SELECT fold, doc_id, count(*) AS n_terms, round(sum(weight), 6) AS total,
               array_to_string(any_value(categories), '|') AS categories
        FROM weights JOIN folded USING (doc_id) GROUP BY fold, doc_id""",
)
def attach_labels(spark, sf_dir):
    """Weights joined with labels and folds by document."""
    weights, _ = weighted(spark, sf_dir)
    features = weights.groupBy("doc_id").agg(
        F.count("*").alias("n_terms"), F.round(F.sum("weight"), 6).alias("total")
    )
    labelled = folds.assign_folds(tables.labels(spark, sf_dir))
    return folds.attach_labels(features, labelled).withColumn(
        "categories", F.array_join("categories", "|")
    )
