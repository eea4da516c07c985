"""The training-data operators as named queries, each over its whole tables."""

from __future__ import annotations

from . import chat, decontaminate, html_text, lines, mixing, quality, repeats, simhash, urls, warc
from .common import table


def op1_html_extraction(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, urls.site_list(pages))


def op3_substring_dedup(spark, sf_dir):
    return repeats.removals(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_chat_formatting(spark, sf_dir):
    nodes = chat.reply_chains(chat.with_trial(table(spark, sf_dir, "conversations")))
    return chat.read_back(chat.formatted(nodes))


def op6_line_dedup(spark, sf_dir):
    return lines.judge(table(spark, sf_dir, "documents"), lines.GROWING, equal_chars=1)


def op7_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_mixing(spark, sf_dir):
    return mixing.calibrate(table(spark, sf_dir, "documents"))


def op9_quality(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_url_filters,
        op3_substring_dedup,
        op4_decontaminate,
        op5_chat_formatting,
        op6_line_dedup,
        op7_warc,
        op8_mixing,
        op9_quality,
        op10_simhash,
    )
}
_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
DECONTAMINATE_SQL = f"""
WITH b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
s AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0),
w AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM s)),
d AS (SELECT doc_id, coalesce({_WORDS}, []) AS ws FROM documents),
p AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS gram FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM w))),
h AS (SELECT doc_id, i, n, item_id FROM p JOIN w USING (n, gram)),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""
WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT html, max(page_id) AS first_id FROM p WHERE n >= 1000 GROUP BY html)
SELECT page_id, n::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON f.html = p.html AND n >= 1000
"""
ORACLE: dict[str, str] = {
    "op2_url_filters": urls.ORACLE,
    "op4_decontaminate": DECONTAMINATE_SQL,
    "op5_chat_formatting": chat.ORACLE,
    "op7_warc": WARC_SQL,
}
