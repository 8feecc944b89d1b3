"""SQL fragments shared by the checking statements."""

from __future__ import annotations

from presswork.functions.text import CONTRACTIONS, default_stopwords

NON_ASCII = r"'[^\x00-\x7F]'"
SPACES = r"'[ \t\n\x0B\f\r]+'"
PUNCT_DIGITS = "!\"#$%&''()*+,./:;<=>?@[\\]^_`{|}~0123456789"


def fold(expr: str) -> str:
    return f"regexp_replace(strip_accents({expr}), {NON_ASCII}, '', 'g')"


def strip(expr: str) -> str:
    return f"translate({expr}, '-{PUNCT_DIGITS}', ' ')"


def contractions(expr: str) -> str:
    for head, tail in CONTRACTIONS:
        expr = rf"regexp_replace({expr}, '\b({head})({tail})\b', '\1 \2', 'gi')"
    return expr


def words(expr: str) -> str:
    return f"string_split_regex({contractions(strip(fold(expr)))}, {SPACES})"


def stop_list() -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in default_stopwords())


def keep(word: str) -> str:
    return f"length({word}) >= 3 AND lower({word}) NOT IN ({stop_list()})"


def stem(word: str) -> str:
    return f"""CASE
        WHEN {word} LIKE '%ies' AND {word} NOT LIKE '%eies' AND {word} NOT LIKE '%aies'
          THEN regexp_replace({word}, 'ies$', 'y')
        WHEN {word} LIKE '%es' AND {word} NOT LIKE '%aes' AND {word} NOT LIKE '%ees'
          AND {word} NOT LIKE '%oes' THEN regexp_replace({word}, 'es$', 'e')
        WHEN {word} LIKE '%s' AND {word} NOT LIKE '%us' AND {word} NOT LIKE '%ss'
          THEN regexp_replace({word}, 's$', '')
        ELSE {word} END"""


DOCS = """docs AS (
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, text AS full_text, [lang, source] AS categories
    FROM documents)"""

LABELS = """labelled AS (
    SELECT CAST(d.doc_id AS VARCHAR) AS doc_id,
           list_concat([d.lang, d.source],
             list_concat(CASE WHEN l.quality = 1 THEN ['quality'] ELSE [] END,
                         CASE WHEN l.toxic = 1 THEN ['toxic'] ELSE [] END)) AS categories
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def tokens() -> str:
    return f"""{DOCS}, tokens AS (
    SELECT doc_id, word FROM (
        SELECT doc_id, unnest({words('full_text')}) AS word FROM docs) WHERE word <> '')"""


def bags() -> str:
    """Bags with the default stopwords and the plural stemmer."""
    return f"""{tokens()}, stemmed AS (
    SELECT doc_id, {stem('w')} AS term
    FROM (SELECT doc_id, lower(word) AS w FROM tokens WHERE {keep('word')})),
bags AS (
    SELECT doc_id, term, count(*) AS tf, CAST(sum(count(*)) OVER (PARTITION BY doc_id) AS BIGINT) AS doc_len
    FROM stemmed WHERE {keep('term')} GROUP BY doc_id, term)"""


def dictionary(min_cf: int) -> str:
    return f"""{bags()}, dictionary AS (
    SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf,
           CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_idx
    FROM bags GROUP BY term HAVING sum(tf) >= {min_cf})"""


def tfidf(min_cf: int) -> str:
    return f"""{dictionary(min_cf)}, weights AS (
    SELECT doc_id, term_idx, term,
           CAST(tf AS DOUBLE) / doc_len * ln((SELECT count(*) FROM docs) / CAST(df AS DOUBLE)) AS weight
    FROM bags JOIN dictionary USING (term))"""


def fold_of(table: str, key: str = "doc_id", k: int = 10, seed: int = 42) -> str:
    return f"""SELECT *, CAST(floor((row_number() OVER (
            ORDER BY md5(concat({key}, ':{seed}'))) - 1)
            / ceil((SELECT count(*) FROM {table}) / {k}.0)) AS INTEGER) AS fold
        FROM {table}"""


POINTS = f"""raw_points AS (
    SELECT vec_id AS doc_id, CAST(embedding AS DOUBLE[]) AS x, concat('c', label) AS category
    FROM embeddings),
points AS ({fold_of('raw_points')})"""

LONG_POINTS = f"""{POINTS}, long_points AS (
    SELECT doc_id, fold, category, i - 1 AS dim, x[i] AS v
    FROM points, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM points))) AS i))"""

POINT_CATEGORIES = """categories AS (
    SELECT concat('c', label) AS category, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS category_idx
    FROM (SELECT DISTINCT label FROM embeddings WHERE label IS NOT NULL))"""
