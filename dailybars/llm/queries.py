"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (divergence, exact_dedup, langid, near_dup, packing, piece_table, polytope,
               sp_tokens, token_counts, toxicity, url_filter, va_search, warc_index)
from .common import ship_package, table


def _op(function: Callable[[DataFrame], DataFrame], name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(table(spark, sf_dir, name))
    return run


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": _op(langid.identify, "documents"),
    "op2_warc_index": _op(warc_index.archive_round_trip, "pages"),
    "op3_exact_top_k": _op(va_search.top_k, "embeddings"),
    "op4_toxicity": _toxicity,
    "op5_sentencepiece": _op(sp_tokens.encoding_report, "documents"),
    "op6_ngram_jaccard_join": _op(near_dup.jaccard_classes, "documents"),
    "op7_token_counts": _op(token_counts.token_counts, "documents"),
    "op8_exact_dedup": _op(exact_dedup.exact_dedup, "documents"),
    "op9_url_filter": _op(url_filter.judge, "pages"),
    "op10_best_fit_packing": _op(packing.best_fit_packing, "documents"),
    "op11_nearest_neighbours": _op(polytope.nearest, "embeddings"),
    "op12_source_divergence": _op(divergence.source_divergence, "documents"),
    "op13_fill_in_middle": _op(piece_table.round_trip, "documents"),
}

ORACLE_SQL: dict[str, str] = {
    "op2_warc_index": r"""
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST((CAST('0x' || substr(h, 10 * (i // 8) + 1, 10) AS BIGINT)
                         >> (35 - 5 * (i % 8))) & 31 AS INT) + 1, 1)
                   for i in range(32)], '') AS payload_digest,
               CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM f""",
    "op3_exact_top_k": r"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding,
                                          lambda x: floor(256 * CAST(x AS DOUBLE))) AS ints
            FROM embeddings),
        s AS (
            SELECT q.vec_id AS query_id, v.vec_id,
                   CAST(list_inner_product(q.ints, v.ints) AS BIGINT) AS score
            FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id
                                         ORDER BY score DESC, vec_id) AS place
            FROM s)
        SELECT query_id, CAST(place AS INT) AS rank, vec_id, score FROM r WHERE place <= 5""",
    "op6_ngram_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(lower(text), '\s+'),
                                       lambda x: x <> '') AS words
            FROM documents),
        sets AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5
                THEN list_transform(range(1, len(words) - 3),
                                    lambda k: array_to_string(words[k : k + 4], ' '))
                WHEN len(words) > 0 THEN [array_to_string(words, ' ')] END) AS shingle
            FROM w),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
            FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY 1, 2),
        linked AS (
            SELECT x, y FROM common c JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 10 * c.n >= 8 * (p.n + q.n - c.n)),
        reach(x, y) AS (
            SELECT x, y FROM linked
            UNION
            SELECT r.x, l.y FROM reach r JOIN linked l ON r.y = l.x)
        SELECT d.doc_id, least(d.doc_id, coalesce(r.low, d.doc_id)) AS class_id,
               coalesce(c.n, 0) AS n_links
        FROM documents d
        LEFT JOIN (SELECT x, min(y) AS low FROM reach GROUP BY x) r ON r.x = d.doc_id
        LEFT JOIN (SELECT x, count(*) AS n FROM linked GROUP BY x) c ON c.x = d.doc_id""",
    "op8_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g'))
                       AS text_sha256
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY text_sha256
                                         ORDER BY n_points DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256
                                  ORDER BY n_points DESC, doc_id) = 1 AS kept,
               text_sha256
        FROM d""",
    "op12_source_divergence": r"""
        WITH t AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang,
                   coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        w AS (SELECT doc, lang, source, unnest(terms) AS term FROM t),
        kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS lang_n
                 FROM w GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
        langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(lang_n) AS lang_total
                  FROM kept GROUP BY lang),
        n AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n
              FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        g AS (SELECT lang, source, coalesce(sum(n), 0) AS total
              FROM (SELECT DISTINCT lang, source FROM t) LEFT JOIN n USING (lang, source)
              GROUP BY ALL),
        p AS (
            SELECT g.lang, g.source, term, coalesce(n, 0) AS n,
                   1 + 1000000000 * (coalesce(n, 0) + 5) // (total + 5 * v) AS p,
                   1 + 1000000000 * (lang_n + 5) // (lang_total + 5 * v) AS q
            FROM g JOIN langs USING (lang) JOIN kept USING (lang)
            LEFT JOIN n USING (lang, source, term)),
        far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
                FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
                GROUP BY ALL),
        r AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                   coalesce(value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN far ON far.lang = a.lang AND far.source = a.source
                         AND far.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
        s AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part
                                           ORDER BY value DESC, item) AS place FROM r)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
               CAST(place AS INT) AS rank
        FROM s WHERE part = 'pair' OR place <= 50""",
    "op13_fill_in_middle": r"""
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   sha256('7:' || CAST(doc_id AS VARCHAR)) AS h,
                   string_split(coalesce(text, ''), chr(10)) AS lines
            FROM documents),
        d AS (
            SELECT *, length(text) - length(replace(text, chr(10), ''))
                      + CASE WHEN text <> '' AND text[-1] <> chr(10) THEN 1 ELSE 0 END AS n,
                   CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                   CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
            FROM t),
        f AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a,
                   greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                             OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM d),
        c AS (
            SELECT *, CASE WHEN a = 0 THEN '' WHEN a = n THEN text
                      ELSE array_to_string(lines[:a], chr(10)) || chr(10) END AS before,
                   CASE WHEN b = 0 THEN '' WHEN b = n THEN text
                   ELSE array_to_string(lines[:b], chr(10)) || chr(10) END AS upto
            FROM f),
        o AS (
            SELECT *, length(before) AS x, length(upto) - length(before) AS y,
                   substr(text, length(before) + 1, length(upto) - length(before)) AS middle,
                   substr(text, length(upto) + 1) AS rest
            FROM c)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
               CASE WHEN form <> 'plain' THEN CAST(x AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(y AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                      WHEN 'psm' THEN '<P>' || before || '<S>' || rest || '<M>' || middle
                      ELSE '<S>' || rest || '<P>' || before || '<M>' || middle END)
                   AS output_sha256,
               sha256(text) AS restored_sha256
        FROM o""",
}
