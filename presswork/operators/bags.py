"""Bags of words, the word dictionary and TF-IDF weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from presswork.functions import text as tx
from presswork.functions.maths import let
from presswork.operators.ranking import dense_index
from presswork.session import scalar

# ---------------------------------------------------------------- token tables


def token_table(
    docs: DataFrame, text: str = "full_text", key: str = "doc_id", words: str | None = None
) -> DataFrame:
    """One row per word occurrence; ``words`` names a column of words that are cut already."""
    return docs.select(key, F.explode(F.col(words) if words else tx.tokens(F.col(text))).alias("word"))


def lexicon_filter(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Keep words found in the lexicon, case-sensitively.

    No broadcast hint: Catalyst broadcasts a lexicon below its size threshold
    and otherwise shuffles, with AQE splitting frequent words.
    """
    return tokens.join(lexicon.select("word"), "word", "left_semi")


def stopword_filter(tokens: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Drop words whose lower-case form is in a stopword table, and short ones."""
    lowered = tokens.where(F.length("word") >= 3).withColumn("word", F.lower("word"))
    return lowered.join(stopwords.select("word"), "word", "left_anti")


def apply_stems(tokens: DataFrame, stems: DataFrame) -> DataFrame:
    """Replace each word by its stem from a ``term -> stem`` table."""
    return tokens.join(stems.select(F.col("term").alias("word"), "stem"), "word").select(
        *[c for c in tokens.columns if c != "word"], F.col("stem").alias("term")
    )


def stem_table(words: DataFrame, stem=tx.plural_stem) -> DataFrame:
    """Stem every distinct word once."""
    return words.select(F.col("word").alias("term")).distinct().withColumn(
        "stem", stem(F.col("term"))
    )


# ------------------------------------------------------------------------ bags


def wide_bags(
    docs: DataFrame,
    text: str = "full_text",
    stopwords=None,
    stem=tx.plural_stem,
) -> DataFrame:
    """One row per document: ``bag array<struct<term, tf>>`` and ``doc_len``.

    Everything happens inside the row, so there is no shuffle, and documents
    without usable words keep their row with an empty bag. ``stem`` maps a
    column to a column; None leaves words as they are.
    """
    stop = tx.default_stopwords() if stopwords is None else tuple(stopwords)
    if stem is None or stem is tx.plural_stem:
        counted = tx.term_counts(F.col(text), stop, plural=stem is not None)
    else:
        kept = F.filter(tx.tokens(F.col(text)), lambda w: tx.keep_word(w, stop))
        terms = F.filter(F.transform(kept, lambda w: stem(F.lower(w))), lambda w: tx.keep_word(w, stop))
        counted = let(
            terms,
            lambda t: F.struct(
                tx.count_words(t).alias("bag"), F.size(t).cast("bigint").alias("doc_len")
            ),
        )
    others = [c for c in docs.columns if c not in (text, "bag", "doc_len")]
    # A generator over one element: filters placed on the result later are not
    # copied below it, so the text is worked through once.
    return docs.select(*others, F.inline_outer(F.array(counted)))


def long_bags(wide: DataFrame, key: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, term, tf, doc_len)``, one row per distinct word of a document."""
    return wide.select(key, *keep, "doc_len", F.inline_outer("bag")).where(
        F.col("term").isNotNull()
    )


def word_counts(
    docs: DataFrame, text: str = "full_text", stopwords=None, words: str | None = None
) -> DataFrame:
    """One row per document: ``words array<struct<term, tf>>`` as written, unstemmed.

    ``words`` names a column of words that are cut already.
    """
    stop = tx.default_stopwords() if stopwords is None else tuple(stopwords)
    kept = F.filter(F.col(words) if words else tx.tokens(F.col(text)), lambda w: tx.keep_word(w, stop))
    others = [c for c in docs.columns if c not in (text, words, "words")]
    return docs.select(
        *others, F.inline_outer(F.array(F.struct(tx.count_words(kept).alias("words"))))
    )


def joined_bags(
    counted: DataFrame,
    lexicon: DataFrame | None = None,
    stems: DataFrame | None = None,
    key: str = "doc_id",
    stopwords=None,
) -> DataFrame:
    """Long bags from ``word_counts`` when the lexicon or the stems come as tables.

    The joins see each distinct word of a document once. They may broadcast or
    shuffle; afterwards a single exchange on the document serves both the
    regrouping by term and the length.
    """
    stop = tx.default_stopwords() if stopwords is None else tuple(stopwords)
    words = (
        counted.select(key, F.inline_outer("words"))
        .where(F.col("term").isNotNull())
        .withColumnRenamed("term", "word")
    )
    if lexicon is not None:
        words = lexicon_filter(words, lexicon)
    lowered = words.withColumn("word", F.lower("word"))
    if stems is None:
        terms = lowered.withColumnRenamed("word", "term")
    else:
        terms = apply_stems(lowered, stems)
    terms = terms.where(tx.keep_word(F.col("term"), stop))
    bags = terms.repartition(key).groupBy(key, "term").agg(F.sum("tf").alias("tf"))
    return bags.withColumn("doc_len", F.sum("tf").over(W.partitionBy(key)))


# ----------------------------------------------------- dictionary and weights


def word_dictionary(bags: DataFrame, min_cf: int = 1) -> DataFrame:
    """Document and collection frequency per term; keep ``cf >= min_cf``."""
    return (
        bags.groupBy("term")
        .agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
        .where(F.col("cf") >= min_cf)
    )


def term_index(dictionary: DataFrame) -> DataFrame:
    """The dictionary with ``term_idx``, its position in term order."""
    return dense_index(dictionary, [F.col("term")], "term_idx")


def known_words(bags: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Bag rows whose term is in the dictionary, with its index and frequency."""
    return bags.join(dictionary.drop("cf"), "term")


def doc_lengths(bags: DataFrame, key: str = "doc_id") -> DataFrame:
    """Words per document, those outside the dictionary included."""
    return bags.groupBy(key).agg(F.sum("tf").alias("doc_len"))


def corpus_size(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    return docs.agg(F.count_distinct(key).alias("n_docs"))


def tfidf(bags: DataFrame, dictionary: DataFrame, docs: DataFrame, keep=("doc_id",)) -> DataFrame:
    """``(tf / doc_len) * ln(N / df)`` per known word; no smoothing, no norm.

    The logarithm is taken once per dictionary row, N is a scalar subquery, and
    the weight is a projection over the one join.
    """
    n_docs = scalar(docs, F.count("*"))
    idf = dictionary.select("term", "term_idx", F.log(n_docs / F.col("df")).alias("idf"))
    return bags.join(idf, "term").select(
        *keep, "term_idx", (F.col("tf") / F.col("doc_len") * F.col("idf")).alias("weight")
    )


def tfidf_rows(weights: DataFrame, keep=("doc_id",)) -> DataFrame:
    """One sparse row per document: parallel arrays ``indices`` and ``weights``."""
    entries = F.array_sort(F.collect_list(F.struct("term_idx", "weight")))
    return (
        weights.groupBy(*keep)
        .agg(entries.alias("e"))
        .select(*keep, F.col("e.term_idx").alias("indices"), F.col("e.weight").alias("weights"))
    )


def top_terms(weights: DataFrame, dictionary: DataFrame, n: int, key: str = "doc_id") -> DataFrame:
    """The ``n`` heaviest terms of each document."""
    order = W.partitionBy(key).orderBy(F.desc("weight"), "term_idx")
    ranked = weights.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.join(dictionary.select("term_idx", "term"), "term_idx").select(
        key, "rank", "term", "weight"
    )
