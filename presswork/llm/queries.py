"""The registered query of every operator of this subpackage, and SQL where it can tell the rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from presswork.llm import (
    bpe, conversations, jaccard, langid, line_dedup, lm, merkle, mixing, quality, secrets, token_count,
    topk, warc,
)
from presswork.llm.common import UPPER, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
COUNTED_VOCABULARY = "word_bpe_49k.json"


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(table(spark, sf_dir, "documents"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(topk.usable(F.col("embedding")))
    vectors = rows.select("vec_id", topk.scaled(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(VOCABULARY)
    return bpe.round_trip_digests(docs, path, public_tokenizers.PATTERN).drop("text")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in secrets.KINDS])

    def listed(spans):
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
        text = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        return F.array_join(F.transform(ordered, text), ",")

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed(F.col("spans")), 256).alias("base_sha256"),
        listed(F.concat("spans", "added")).alias("spans"),
    )


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    trusted, judged = quality.trusted_documents(labels), quality.good_documents(labels)
    made = quality.with_quality(docs, trusted, judged=judged, plain=False, keep=["doc_id"])
    return made.select("doc_id", "quality.*")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).drop("payload")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(table(spark, sf_dir, "conversations")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = merkle.tampered_leaves(table(spark, sf_dir, "documents"))
    found = merkle.proofs(merkle.build_manifest(leaves, payload=["tampered"]), "tampered")
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.count_tokens(docs, public_tokenizers.path(COUNTED_VOCABULARY))


QUERIES = {
    f.__name__: f
    for f in (
        op1_lm_scoring, op2_language_id, op3_exact_top_k, op4_line_dedup, op5_ngram_jaccard,
        op6_byte_bpe, op7_secret_scan, op8_source_mix, op9_quality_rules, op10_warc, op11_conversation_repair,
        op12_merkle_manifest, op13_token_counts,
    )
}

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = f"translate({{}}, '{UPPER}', '{UPPER.lower()}')"
WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

# CRC-32 of a string of ASCII characters; needs the column ``crcs`` of CRC_TABLE.
CRC_TABLE = """SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
            lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS crcs"""
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(string_split({}, ''), lambda x: ascii(x)::BIGINT)),
            lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])))"""


def _leaf_sql(text: str) -> str:
    parts = ["doc_id", "source", "lang", "n_chars", text]
    shown = [f"coalesce(strlen({p}::VARCHAR) || ':' || {p}::VARCHAR, '-')" for p in parts]
    return f"sha256({' || '.join(shown)})"


ORACLE = {
    "op3_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 50 = 0
        ), ranked AS (
            SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
                   vec_id, score
            FROM pairs
        )
        SELECT * FROM ranked WHERE rank <= 5
    """,
    "op4_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, u.i, u.line, {LOWER.format(f"trim(u.line, {BLANKS})")} AS key
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
                 unnest(list_zip(l, range(len(l)))) AS t(p), (SELECT p[1] AS line, p[2] AS i) AS u
        ), firsts AS (
            SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10
            GROUP BY key HAVING min(doc_id) < max(doc_id)
        ), marked AS (
            SELECT lines.*, coalesce(doc_id > first, FALSE) AS lost FROM lines LEFT JOIN firsts USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op5_ngram_jaccard": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_transform({WORDS}, lambda w: {LOWER.format("w")}) AS w FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
            FROM words
        ), flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id
            HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
        ), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
        ), degree AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
        SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, coalesce(n_links, 0)::BIGINT AS n_links
        FROM sets JOIN least USING (doc_id) LEFT JOIN degree USING (doc_id)
    """,
    "op8_source_mix": f"""
        WITH docs AS (
            SELECT doc_id, source, text, len({WORDS})::BIGINT AS size FROM documents
        ), per AS (
            SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source
        ), weighed AS (
            SELECT *, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight,
                   3 * source_size AS cap FROM per
        ), filled AS (
            SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
                   / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS share,
                   row_number() OVER (ORDER BY cap / weight, encode(source) NULLS LAST) AS r
            FROM weighed
            WINDOW before AS (ORDER BY cap / weight, encode(source) NULLS LAST
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), level AS (SELECT arg_min(share, r) AS s FROM filled WHERE cap / weight >= share
        ), targets AS (
            SELECT source, source_size, coalesce(least(cap::DOUBLE, s * weight), cap::DOUBLE) AS target,
            FROM filled LEFT JOIN level ON TRUE
        ), plan AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM targets
        ), keyed AS (
            SELECT *, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 13))::BIGINT + 0.5)
                      / 4503599627370496.0)
                / CASE WHEN size > 0 THEN greatest(least(length(text) / size / 6.0, 6.0 / (length(text) / size)), 1e-3)
                       ELSE 1.0 END AS key
            FROM docs
        ), drawn AS (
            SELECT doc_id, size, source_size, target, epochs,
                   coalesce(sum(size) OVER (PARTITION BY keyed.source ORDER BY key, doc_id, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2
                   <= target - epochs * source_size AS hit
            FROM keyed JOIN plan ON keyed.source IS NOT DISTINCT FROM plan.source
        )
        SELECT doc_id, size, source_size, target,
               CASE WHEN size > 0 THEN size * (epochs + hit::BIGINT) ELSE 0 END::BIGINT AS taken
        FROM drawn
    """,
    "op10_warc": """
        WITH rows AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), largest AS (
            SELECT html, max(page_id) AS target FROM rows WHERE payload_bytes >= 1000 GROUP BY html
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id < target THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < target THEN target END AS refers_to
        FROM rows LEFT JOIN largest USING (html)
    """,
    "op11_conversation_repair": f"""
        WITH RECURSIVE filled AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {CRC.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fate
            FROM conversations, ({CRC_TABLE})
        ), damaged AS (
            SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(range(CASE fate WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM filled WHERE fate <> 0
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                   trim(text, {BLANKS}) AS bare, left(role, 1) AS c
            FROM damaged
        ), marked AS (
            SELECT *, CASE WHEN bare = '' THEN 'blank'
                           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                           WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                   lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS before
            FROM placed
        ), counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
            FROM marked GROUP BY conv_id
        ), ways AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0, 'audit': '', 'lines': ''}} AS best FROM conversations
            UNION ALL
            SELECT conv_id, i, q, min(best) FROM (
                SELECT s.conv_id, r.i,
                       CASE l WHEN 'D' THEN p WHEN 'R' THEN CASE p WHEN 2 THEN 3 ELSE 2 END
                              ELSE CASE c WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END END AS q,
                       {{'cost': s.best.cost + 3 * j + CASE l WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
                             + CASE WHEN l <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END,
                        'audit': s.best.audit || repeat('I', j) || l,
                        'lines': s.best.lines || CASE WHEN j > 0 THEN chr(10) || rolename || ':' ELSE '' END
                             || CASE WHEN j > 1 THEN chr(10) || CASE q WHEN 2 THEN 'user:' ELSE 'assistant:' END ELSE '' END
                             || CASE l WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text
                                ELSE chr(10) || CASE p WHEN 2 THEN 'assistant' ELSE 'user' END || ':' || text END}} AS best
                FROM (SELECT *, CASE WHEN j = 0 THEN q WHEN (q = 2) = (j = 1) THEN 3 ELSE 2 END AS p,
                             CASE q WHEN 2 THEN 'assistant' ELSE 'user' END AS rolename
                      FROM (SELECT *, unnest([0, 1, 2]) AS j FROM ways)) s
                JOIN marked r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1,
                (VALUES ('D'), ('K'), ('R')) AS letters(l)
                WHERE l = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (l = 'R'
                      OR (c = 's' AND p = 0) OR (c = 'u' AND p <> 2) OR (c = 'a' AND p = 2)))
            ) GROUP BY conv_id, i, q
        ), ended AS (
            SELECT w.conv_id, min({{'cost': best.cost + CASE q WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END,
                    'audit': best.audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
                    'lines': best.lines || CASE q WHEN 1 THEN chr(10) || 'user:' || chr(10) || 'assistant:'
                                                  WHEN 2 THEN chr(10) || 'assistant:' ELSE '' END}}) AS best
            FROM ways w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
            WHERE w.i = coalesce(c.n, 0) GROUP BY w.conv_id
        )
        SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
               coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
               coalesce(illegal, 0)::BIGINT AS illegal, best.cost::BIGINT AS cost, best.audit AS audit,
               sha256(substr(best.lines, 2)) AS repaired_sha256
        FROM ended e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
    """,
    "op12_merkle_manifest": f"""
        WITH RECURSIVE leaves AS (
            SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
                   CASE WHEN {CRC.format("doc_id::VARCHAR")} % 2 = 0
                        THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS tampered
            FROM documents, ({CRC_TABLE})
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves
        ), lower AS (
            SELECT source, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM placed
            UNION ALL
            SELECT source, any_value(level) + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 2) // 3
            FROM lower WHERE n > 1 GROUP BY source, i // 3
        ), subroots AS (
            SELECT source, level AS height, h AS subroot,
                   row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS i FROM lower WHERE n = 1
        ), upper AS (
            SELECT 0 AS level, i, subroot AS h, count(*) OVER () AS n FROM subroots
            UNION ALL
            SELECT any_value(level) + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 2) // 3
            FROM upper WHERE n > 1 GROUP BY i // 3
        ), root AS (SELECT h AS root FROM upper WHERE n = 1
        ), nodes AS (
            SELECT source, FALSE AS top, level, i, h FROM lower
            UNION ALL SELECT NULL, TRUE, level, i, h FROM upper
        ), ranges AS (
            SELECT source, top, level, i // 3 AS run, list(h ORDER BY i) AS hs FROM nodes GROUP BY ALL
        ), steps AS (
            SELECT 0 AS step, placed.*, height, subroots.i AS place, subroot, '' AS proof, tampered AS folded
            FROM placed JOIN subroots ON placed.source IS NOT DISTINCT FROM subroots.source
            UNION ALL
            SELECT step + 1, doc_id, s.source, leaf, tampered,
                   CASE WHEN step < height THEN s.i // 3 ELSE s.i END, height,
                   CASE WHEN step < height THEN place ELSE place // 3 END, subroot,
                   proof || array_to_string(hs[:j - 1], '') || array_to_string(hs[j + 1:], ''),
                   sha256(array_to_string(hs[:j - 1], '') || folded || array_to_string(hs[j + 1:], ''))
            FROM (SELECT *, step >= height AS up, CASE WHEN step < height THEN i ELSE place END AS p, p % 3 + 1 AS j
                  FROM steps) s
            JOIN ranges r ON r.top = s.up AND r.run = s.p // 3
              AND r.level = CASE WHEN up THEN step - height ELSE step END
              AND (up OR r.source IS NOT DISTINCT FROM s.source)
            WHERE step < height + (SELECT max(level) FROM upper)
        )
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
        FROM steps, root WHERE step = height + (SELECT max(level) FROM upper)
    """,
}
