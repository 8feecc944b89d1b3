import unicodedata

import pytest
from pyspark.sql import functions as F

from presswork.functions import text as tx
from presswork.sources import articles


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value",
    ["plain", "café Ünïcode", "ﬁne ½ … Ⅷ", "ｆｕｌｌ", "a b c", "한국 naïve", "𝐁old 🄐x", "“q” – ’", ""],
)
def test_fold_ascii_equals_nfkd(spark, value):
    expected = unicodedata.normalize("NFKD", value).encode("ascii", "ignore").decode()
    assert one(spark, value, tx.fold_ascii) == expected


def test_strip_punct_digits(spark):
    assert one(spark, "LANTERN'S half-dozen-odd, 12.5% (x_y)\\", tx.strip_punct_digits) == (
        "LANTERNS half dozen odd  xy"
    )


def test_tokens_split_contractions(spark):
    assert one(spark, "  I cannot, GONNA go;\tcannots\n", tx.tokens) == [
        "I", "can", "not", "GON", "NA", "go", "cannots",
    ]
    assert one(spark, " ... 12 ", tx.tokens) == []


def test_count_words(spark):
    counted = one(spark, "b a b c b a", lambda c: tx.count_words(F.split(c, " ")))
    assert [(r["term"], r["tf"]) for r in counted] == [("a", 2), ("b", 3), ("c", 1)]
    assert one(spark, "", lambda c: tx.count_words(tx.tokens(c))) == []


@pytest.mark.parametrize(
    "word,stem",
    [("queries", "query"), ("skies", "sky"), ("horses", "horse"), ("cats", "cat"), ("bus", "bus"),
     ("glass", "glass"), ("toes", "toe"), ("dog", "dog")],
)
def test_plural_stem(spark, word, stem):
    assert one(spark, word, tx.plural_stem) == stem


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("Arts; Dining and Wine", ["arts", "dining", "wine"]),
        ("Islands", ["isl", "s"]),
        ("A And B", ["a and b"]),
        ("New York (Region), Books;;", ["new york", "region", "books"]),
        ("\t X \n; x", ["x", "x"]),
    ],
)
def test_split_sections(spark, raw, expected):
    assert one(spark, raw, tx.split_sections) == expected


def test_split_sections_on_whole_words(spark):
    assert one(spark, "Islands and Sea", lambda c: tx.split_sections(c, True)) == ["islands", "sea"]


ARTICLE = """<?xml version="1.0" encoding="UTF-8"?>
<!DOCTYPE nitf SYSTEM "http://example.org/nitf.dtd">
<nitf><head><title>T</title>{meta}<docdata>{ids}<identified-content>
<location class="x">Here</location><location>There</location></identified-content></docdata></head>
<body><body.content>{blocks}</body.content></body></nitf>"""


def parse(spark, meta="", ids='<doc-id id-string="7"/>', blocks=""):
    xml = ARTICLE.format(meta=meta, ids=ids, blocks=blocks)
    return articles.parse_articles(spark.createDataFrame([(xml,)], "xml string"), "xml")


def test_full_text_rules(spark):
    blocks = (
        '<block class="lead_paragraph"><p>no</p></block>'
        '<block class="full_text"><p>One &amp; two</p><p>LEAD: one</p><p>cut <em>here</em> x</p><p/></block>'
        '<block class="full_text"><p>café “q”</p><p>lead: stays</p></block>'
    )
    row = articles.to_docs(parse(spark, blocks=blocks)).first()
    assert row["full_text"] == "\nOne & two\ncut \n\ncafe q\nlead: stays"
    assert row["categories"] == []


def test_last_doc_id_wins_and_missing_id_is_rejected(spark):
    two = parse(spark, ids='<doc-id id-string="1"/><doc-id id-string="2"/>')
    assert two.select(articles.article_doc_id()).first()[0] == "2"
    none = articles.to_docs(parse(spark, ids=""))
    assert none.first()["doc_id"] is None
    assert articles.rejects(none).count() == 1


def test_categories_of_several_entries(spark):
    meta = (
        '<meta content="Arts; Arts" name="online_sections"/><meta content="x" name="slug"/>'
        '<meta content="Books" name="online_sections"/>'
    )
    row = articles.to_docs(parse(spark, meta=meta)).first()
    assert row["categories"] == ["arts", "arts", "books"]
    assert articles.drop_unusable(articles.to_docs(parse(spark, meta=meta))).count() == 0


def test_metadata(spark):
    meta = "".join(
        f'<meta content="{v}" name="publication_{k}"/>'
        for k, v in [("day_of_month", 1), ("month", 11), ("year", 2006)]
    )
    row = articles.article_metadata(parse(spark, meta=meta)).first()
    assert row["locations"] == ["Here", "There"]
    assert str(row["pub_date"]) == "2006-11-01"
    assert articles.article_metadata(parse(spark)).first()["pub_date"] is None


def test_read_articles_takes_nested_folders_and_names_with_xml(spark, tmp_path):
    text = ARTICLE.format(meta="", ids='<doc-id id-string="{}"/>', blocks="")
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.xml").write_text(text.format(1))
    (tmp_path / "sub" / "b.xml.txt").write_text(text.format(2))
    (tmp_path / "c.txt").write_text(text.format(3))
    found = articles.read_articles(spark, str(tmp_path)).select(articles.article_doc_id().alias("i"))
    assert sorted(r["i"] for r in found.collect()) == ["1", "2"]


def test_stripping_looks_letters_up(spark):
    """No class of ranges per letter; hyphens become blanks, other ASCII signs and digits go, the rest stays."""
    from pyspark.sql import functions as F
    from presswork.functions import text as tx

    rows = [(chr(c), f"a{chr(c)}b") for c in (*range(1, 0x250), 0x2028, 0x1F600)] + [("", None)]
    df = spark.createDataFrame(rows, "c string, t string").select("c", tx.strip_punct_digits(F.col("t")).alias("s"))
    assert "regexp" not in df._jdf.queryExecution().executedPlan().toString().lower()
    for c, got in df.collect():
        gone = len(c) == 1 and c.isascii() and c.isprintable() and not c.isalpha() and c != " "
        assert got == (None if c == "" else "a b" if c == "-" else "ab" if gone else f"a{c}b"), ascii(c)
