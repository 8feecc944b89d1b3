"""NITF articles: files or XML strings to (doc_id, categories, full_text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from presswork import schemas
from presswork.functions.text import fold_ascii, split_sections

ROW_TAG = "nitf"


def read_articles(spark: SparkSession, path: str, name_glob: str = "*xml*") -> DataFrame:
    """Every article below ``path`` whose file name contains ``xml``."""
    return (
        spark.read.format("xml")
        .option("rowTag", ROW_TAG)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .schema(schemas.ARTICLE)
        .load(path)
    )


def write_articles(articles: DataFrame, path: str) -> None:
    """Article structs back to XML files, readable by ``read_articles``."""
    (
        articles.write.format("xml")
        .option("rootTag", "articles")
        .option("rowTag", ROW_TAG)
        .save(path)
    )


def parse_articles(df: DataFrame, column: str) -> DataFrame:
    """Articles held as XML text in a table column; other columns are kept."""
    parsed = F.from_xml(df[column], schemas.ARTICLE, {"rowTag": ROW_TAG})
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, parsed.alias("article")).select(*rest, "article.*")


def article_doc_id() -> Column:
    """The last ``doc-id``; null when the article has none."""
    return F.try_element_at(F.col("head.docdata.`doc-id`.`_id-string`"), F.lit(-1))


def meta_values(name: str) -> Column:
    entries = F.filter(F.col("head.meta"), lambda m: m["_name"] == name)
    return F.transform(entries, lambda m: m["_content"])


def article_categories(word_boundary: bool = False) -> Column:
    """Categories of every ``online_sections`` entry, in document order."""
    split = F.transform(
        meta_values("online_sections"), lambda s: split_sections(s, word_boundary)
    )
    return F.coalesce(F.flatten(split), F.array().cast("array<string>"))


def article_full_text() -> Column:
    """Paragraphs of the ``full_text`` blocks, each preceded by a newline.

    A paragraph ends at its first child element, is folded to ASCII and is
    dropped when it repeats the lead (contains ``LEAD:``).
    """
    blocks = F.filter(
        F.col("body.`body.content`.block"), lambda b: b["_class"] == "full_text"
    )
    per_block = F.transform(blocks, lambda b: F.coalesce(b["p"], F.array().cast("array<string>")))
    texts = F.transform(
        F.flatten(per_block),
        lambda p: fold_ascii(
            F.regexp_replace(F.coalesce(p, F.lit("")), r"(?s)<[A-Za-z].*$", "")
        ),
    )
    kept = F.filter(texts, lambda p: ~F.contains(p, F.lit("LEAD:")))
    body = F.array_join(F.transform(kept, lambda p: F.concat(F.lit("\n"), p)), "")
    return F.coalesce(body, F.lit(""))


def to_docs(articles: DataFrame, word_boundary: bool = False) -> DataFrame:
    return articles.select(
        article_doc_id().alias("doc_id"),
        article_categories(word_boundary).alias("categories"),
        article_full_text().alias("full_text"),
    )


def rejects(docs: DataFrame) -> DataFrame:
    """Articles without a document id, kept apart instead of failing the job."""
    return docs.where(F.col("doc_id").isNull())


def drop_unusable(docs: DataFrame) -> DataFrame:
    """Keep documents that have an id, at least one category and some text."""
    return docs.where(
        F.col("doc_id").isNotNull()
        & (F.size("categories") > 0)
        & (F.length("full_text") > 0)
    )


def article_metadata(articles: DataFrame) -> DataFrame:
    """Title, id, places, date parts and raw sections of each article."""

    def first(name: str) -> Column:
        return F.get(meta_values(name), 0)

    day, month, year = (
        first(f"publication_{part}") for part in ("day_of_month", "month", "year")
    )
    return articles.select(
        article_doc_id().alias("doc_id"),
        F.col("head.title").alias("title"),
        F.transform(
            F.col("head.docdata.`identified-content`.location"), lambda c: c["_VALUE"]
        ).alias("locations"),
        day.alias("day"),
        month.alias("month"),
        year.alias("year"),
        first("online_sections").alias("online_sections"),
        F.make_date(
            year.try_cast("int"), month.try_cast("int"), day.try_cast("int")
        ).alias("pub_date"),
    )
