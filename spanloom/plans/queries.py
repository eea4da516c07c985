"""The engine's operators as named queries over the star schema, each with its SQL where SQL expresses it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import numerals, text
from ..operators import align, brackets, dates, merge, publish, spans, validate
from ..sources import html, sinks
from ..streaming import jobs
from . import corpus_queries, service

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: White space as in functions.text.SPACE, for SQL.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EMAIL = "[A-Za-z0-9._]+@[A-Za-z0-9.]+"
WORDS = ["license", "Licensed under", "Licensed", "password", "trash", "worthless", "the the", "thing the"]
TITLES = ["that", "tion "]


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = re.sub("(?<!')\\bat\\b(?!')", '"at"', sql)  # a reserved word
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def big(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def sql_matches(table: str, key: str, rx: str) -> str:
    """Rows (key, n, at, surface) of all matches, found one behind the other."""
    return f"""
    WITH RECURSIVE m AS (SELECT {key}, text, regexp_extract_all(text, '{rx}') AS ms FROM {table} WHERE regexp_matches(text, '{rx}')),
    r AS (
      SELECT {key}, 0 AS n, 1 AS nxt, NULL::BIGINT AS at, NULL::VARCHAR AS surface FROM m
      UNION ALL
      SELECT r.{key}, n + 1, (nxt - 1 + strpos(substr(m.text, nxt), ms[n + 1]) + length(ms[n + 1]))::INT,
             (nxt - 2 + strpos(substr(m.text, nxt), ms[n + 1]))::BIGINT, ms[n + 1]
      FROM r JOIN m ON r.{key} = m.{key} WHERE n < len(ms))"""


def sql_places(table: str, keys: str, literal: str, out: str = "at", where: str = "true") -> str:
    """Rows (keys, at) of a literal's occurrences."""
    return f"""(SELECT {keys}, (list_sum(list_transform(parts[1:k], lambda x: length(x))) + (k - 1) * {len(literal)})::BIGINT AS {out}
      FROM (SELECT *, unnest(range(1, len(parts))) AS k FROM (SELECT *, string_split(text, '{literal}') AS parts FROM {table} WHERE {where})))"""


# Scalar layer


@query(f"SELECT doc_id, sha256(regexp_replace(text, '{SPACE}+', '', 'g')) AS hash FROM documents")
def canonical_hash(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.canonical_hash(F.col("text")).alias("hash"))


@query(f"""SELECT hash, count(*) AS n, min(doc_id) AS first_doc FROM (
  SELECT doc_id, sha256(translate(regexp_replace(regexp_replace(text, '{SPACE}+', '', 'g'), '\\p{{P}}', '', 'g'), '{UPPER}', '{LOWER}')) AS hash FROM documents)
  GROUP BY hash HAVING count(*) > 1""")
def normalized_hash_dupes(spark, sf_dir):
    hashed = read(spark, sf_dir, "documents").select("doc_id", text.normalized_hash(F.col("text"), (UPPER, LOWER)).alias("hash"))
    return hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


@query(f"SELECT source, sha256(string_agg(h, chr(10) ORDER BY id)) AS hash FROM (SELECT source, doc_id::VARCHAR AS id, sha256(regexp_replace(text, '{SPACE}+', '', 'g')) AS h FROM documents) GROUP BY source")
def file_hash_by_source(spark, sf_dir):
    pair = F.struct(F.col("doc_id").cast("string").alias("id"), text.canonical_hash(F.col("text")).alias("h"))
    return read(spark, sf_dir, "documents").groupBy("source").agg(text.ordered_hash(F.collect_list(pair)).alias("hash"))


@query("SELECT doc_id, lang FROM documents WHERE length(regexp_replace(text, '[^A-Za-z]', '', 'g')) >= 500")
def letter_min_filter(spark, sf_dir):
    return read(spark, sf_dir, "documents").where(text.has_min(F.col("text"), "[A-Za-z]", 500)).select("doc_id", "lang")


@query("""SELECT doc_id, CASE WHEN at > 25 THEN '…' ELSE '' END || substr(text, greatest(at - 25, 0) + 1, least(at + 65, length(text)) - greatest(at - 25, 0)) || CASE WHEN at + 65 < length(text) THEN '…' ELSE '' END AS snippet
  FROM (SELECT doc_id, text, least(doc_id % 200, length(text)) AS at FROM documents)""")
def snippets(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").withColumn("at", F.least(F.col("doc_id") % 200, F.length("text")).cast("int"))
    return docs.select("doc_id", text.snippet(F.col("text"), F.col("at")).alias("snippet"))


@query("""SELECT n, numeral, n AS back, CASE WHEN n <= 12 THEN n END AS month FROM (
  SELECT range AS n, CASE WHEN range // 10 > 1 THEN ('一二三四五六七八九')[range // 10] ELSE '' END || CASE WHEN range >= 10 THEN '十' ELSE '' END || CASE WHEN range % 10 > 0 THEN ('一二三四五六七八九')[range % 10] ELSE '' END AS numeral
  FROM range(1, 100))""")
def chinese_numerals(spark, sf_dir):
    rows = spark.range(1, 100).select(F.col("id").alias("n")).withColumn("numeral", numerals.from_int(F.col("n")))
    return rows.select("n", "numeral", big(numerals.to_int(F.col("numeral"))).alias("back"), big(numerals.to_month(F.col("numeral"))).alias("month"))


_HTML = "regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>', ' ', 'g')"
_ENTITIES = "replace(replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')"


@query(f"SELECT page_id, trim(regexp_replace({_ENTITIES.format(f"regexp_replace({_HTML}, '<[^>]+>', ' ', 'g')")}, '[ \\t\\r\\n]+', ' ', 'g'), ' ') AS visible FROM pages")
def strip_html_text(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", html.visible_text(F.col("html")).alias("visible"))


@query(f"""SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS para_no, plain FROM (
  SELECT page_id, pos, regexp_replace({_ENTITIES.format("regexp_replace(raw, '<[^>]+>', '', 'g')")}, '{SPACE}+', '', 'g') AS plain
  FROM (SELECT page_id, unnest(ps) AS raw, generate_subscripts(ps, 1) AS pos FROM (SELECT page_id, regexp_extract_all(html, '(?s)<p\\b[^>]*>(.*?)</p>', 1) AS ps FROM pages)))
  WHERE length(regexp_replace(plain, '[^A-Za-z]', '', 'g')) >= 5 AND NOT contains(plain, 'Cookies')""")
def page_paragraphs(spark, sf_dir):
    found = html.paragraphs(read(spark, sf_dir, "pages"), "page_id", F.col("html"), "[A-Za-z]", 5, "Cookies")
    return found.select("page_id", big("para_no").alias("para_no"), F.col("text").alias("plain"))


@query(f"SELECT page_id, trim({_ENTITIES.format("regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '<[^>]+>', '', 'g')")}, ' ') AS title FROM pages")
def page_title(spark, sf_dir):
    raw = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    return read(spark, sf_dir, "pages").select("page_id", F.trim(text.unescape_basic(text.strip_tags(raw))).alias("title"))


# Spans


@query(sql_matches("documents", "doc_id", EMAIL) + " SELECT doc_id, at, length(surface) AS length, surface FROM r WHERE n > 0")
def span_find_regex(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").where(F.col("text").rlike(EMAIL))
    return docs.select("doc_id", F.inline(spans.find_all(F.col("text"), EMAIL))).select("doc_id", big("at").alias("at"), big("length").alias("length"), "surface")


@query(sql_matches("documents", "doc_id", "|".join(sorted(WORDS, key=len, reverse=True))) + " SELECT doc_id, at, length(surface) AS length, surface FROM r WHERE n > 0")
def dictionary_spans(spark, sf_dir):
    return spans.dictionary_spans(read(spark, sf_dir, "documents"), WORDS).select("doc_id", big("at").alias("at"), big("length").alias("length"), "surface")


@query(f"""WITH hits AS {sql_places("(SELECT doc_id, lower(text) AS text FROM documents)", "doc_id", "then the", where="contains(text, 'then the')")},
  texts AS (SELECT doc_id, text FROM documents)
  SELECT doc_id, at, CASE WHEN at > 40 THEN '…' ELSE '' END || substr(text, greatest(at - 40, 0) + 1, least(at + 40, length(text)) - greatest(at - 40, 0)) || CASE WHEN at + 40 < length(text) THEN '…' ELSE '' END AS snippet,
         (SELECT count(*) FROM hits) AS n_total
  FROM hits JOIN texts USING (doc_id) ORDER BY doc_id, at LIMIT 50""")
def literal_search_topk(spark, sf_dir):
    return service.search(read(spark, sf_dir, "documents"), "then the", ["doc_id"]).select("doc_id", big("at").alias("at"), "snippet", "n_total")


@query(f"""WITH o AS {sql_places("documents", "doc_id", "that the", where="contains(text, 'that the')")},
  m AS (SELECT doc_id, at, 'that' AS surface FROM {sql_places("documents", "doc_id", "that")} UNION ALL SELECT doc_id, at, 'tion ' FROM {sql_places("documents", "doc_id", "tion ")})
  SELECT doc_id, surface, at FROM m WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.doc_id = m.doc_id AND m.at >= o.at AND m.at < o.at + 8)""")
def marker_unresolved(spark, sf_dir):
    from ..operators.persons import unresolved_titles

    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.lit(0).alias("seg_idx"), F.col("doc_id").cast("string").alias("seg_id"), "text")
    known = docs.where(F.contains("text", F.lit("that the"))).select("doc", "seg_idx", F.explode(spans.occurrences(F.col("text"), "that the")).alias("at"), F.lit(8).alias("length"))
    return unresolved_titles(docs, known, TITLES).select(F.col("doc").alias("doc_id"), "surface", big("at").alias("at"))


@query(f"""WITH c AS (SELECT conv_id, turn, text FROM conversations WHERE contains(text, 'that')),
  full_ AS {sql_places("c", "conv_id, turn", "that")},
  short AS (SELECT s.conv_id, s.turn, s.at, c.text FROM {sql_places("c", "conv_id, turn", "at")} s JOIN c USING (conv_id, turn))
  SELECT conv_id, turn, at FROM short s
  WHERE NOT EXISTS (SELECT 1 FROM full_ f WHERE f.conv_id = s.conv_id AND f.turn = s.turn AND s.at >= f.at AND s.at < f.at + 4)
    AND NOT (at > 0 AND substr(text, at, 3) IN ('eat', 'ati')) AND NOT (at + 3 <= length(text) AND substr(text, at + 1, 3) IN ('eat', 'ati'))""")
def contextual_short_match(spark, sf_dir):
    from ..operators.persons import given_names

    segments = read(spark, sf_dir, "conversations").where(F.contains("text", F.lit("that"))).select(F.col("conv_id").alias("doc"), F.col("turn").alias("seg_idx"), F.lit("").alias("seg_id"), "text")
    roster = spark.createDataFrame([("x", "at", ["eat", "ati"])], "id string, given_name string, given_name_blockers array<string>")
    names = segments.select("doc", "seg_idx", F.explode(spans.occurrences(F.col("text"), "that")).alias("at"), F.lit(4).alias("length"))
    return given_names(segments, roster, names).select(F.col("doc").alias("conv_id"), F.col("seg_idx").alias("turn"), big("at").alias("at"))


@query("""WITH RECURSIVE s AS (
  SELECT user_id, (event_id * 7) % 100 AS at, event_id % 13 + 1 AS length, row_number() OVER (PARTITION BY user_id ORDER BY (event_id * 7) % 100, -(event_id % 13 + 1), event_id) AS k
  FROM (SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id, (event_id * 7) % 100)),
  g AS (
    SELECT user_id, k, at, length, true AS kept, at + length AS until_ FROM s WHERE k = 1
    UNION ALL
    SELECT s.user_id, s.k, s.at, s.length, s.at >= g.until_, CASE WHEN s.at >= g.until_ THEN s.at + s.length ELSE g.until_ END FROM g JOIN s ON s.user_id = g.user_id AND s.k = g.k + 1)
  SELECT user_id, at, length FROM g WHERE kept""")
def greedy_dedupe(spark, sf_dir):
    events = read(spark, sf_dir, "events").groupBy("user_id", ((F.col("event_id") * 7) % 100).alias("at")).agg(F.max("event_id").alias("event_id"))
    rows = events.select("user_id", "at", (F.col("event_id") % 13 + 1).alias("length"))
    return spans.greedy_spans(rows, "user_id").select("user_id", big("at").alias("at"), big("length").alias("length"))


@query("""WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place, event_type FROM events),
  a AS (SELECT *, event_type = 'purchase' AS anchor FROM e WHERE event_type IN ('purchase', 'signup')),
  g AS (SELECT *, CASE WHEN place - lag(place) OVER (PARTITION BY user_id ORDER BY place) > 8 THEN 1 ELSE 0 END AS cut FROM a),
  i AS (SELECT *, sum(cut) OVER (PARTITION BY user_id ORDER BY place) AS island FROM g)
  SELECT user_id, event_id FROM (SELECT *, bool_or(anchor) OVER (PARTITION BY user_id, island ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM i) WHERE NOT anchor AND seen""")
def carry_islands(spark, sf_dir):
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    rows = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", place.alias("place")).where(F.col("event_type").isin("purchase", "signup"))
    return spans.carry(rows.withColumn("anchor", F.col("event_type") == "purchase"), ["user_id"], "place").select("user_id", "event_id")


@query("""SELECT o_orderkey FROM orders o WHERE NOT EXISTS (
  SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND o_orderdate < l_shipdate + INTERVAL 10 DAY AND o_orderdate + INTERVAL 60 DAY > l_shipdate)""")
def interval_overlap_anti(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("at"), (F.col("o_orderdate") + F.expr("INTERVAL 60 DAY")).alias("end"))
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_shipdate").alias("at"), (F.col("l_shipdate") + F.expr("INTERVAL 10 DAY")).alias("end"))
    return spans.overlap_anti(orders, lines, "key").select(F.col("key").alias("o_orderkey"))


@query("""SELECT name, follows, count(*) AS n_introduced, count(DISTINCT doc_id) AS n_docs FROM (
  SELECT doc_id, regexp_extract(hit, '^([A-Z][a-z]+), ([a-z]+)$', 1) AS name, regexp_extract(hit, '^([A-Z][a-z]+), ([a-z]+)$', 2) AS follows
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+, [a-z]+')) AS hit FROM documents))
  GROUP BY name, follows HAVING count(*) >= 2""")
def intro_pattern(spark, sf_dir):
    rx = "^([A-Z][a-z]+), ([a-z]+)$"
    hits = read(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Z][a-z]+, [a-z]+"), 0)).alias("hit"))
    per = hits.groupBy("doc_id", F.regexp_extract("hit", rx, 1).alias("name"), F.regexp_extract("hit", rx, 2).alias("follows")).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("name", "follows").agg(F.sum("n").alias("n_introduced"), F.count(F.lit(1)).alias("n_docs")).where("n_introduced >= 2")


# Brackets, sections and parts

_CHARS = """c AS (SELECT page_id, unnest(string_split(html, '')) AS ch, generate_subscripts(string_split(html, ''), 1) - 1 AS at FROM pages),
  b AS (SELECT page_id, at, ch AS bracket, CASE WHEN ch = '<' THEN 1 ELSE -1 END AS step FROM c WHERE ch IN ('<', '>')),
  d AS (SELECT *, sum(step) OVER (PARTITION BY page_id ORDER BY at) AS depth, -sum(step) OVER (PARTITION BY page_id ORDER BY at DESC) AS back FROM b)"""


@query(f"WITH {_CHARS} SELECT page_id, count(*) AS n_brackets, max(depth)::BIGINT AS deepest, min(depth)::BIGINT AS lowest FROM d GROUP BY page_id")
def bracket_depth(spark, sf_dir):
    d = brackets.depths(read(spark, sf_dir, "pages"), "page_id", "html", "<", ">")
    return d.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_brackets"), big(F.max("depth")).alias("deepest"), big(F.min("depth")).alias("lowest"))


@query(f"""WITH {_CHARS},
  e AS (SELECT *, least(0, coalesce(min(depth) OVER (PARTITION BY page_id ORDER BY at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low,
               least(0, coalesce(min(back) OVER (PARTITION BY page_id ORDER BY at DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS back_low FROM d)
  SELECT page_id, at::BIGINT AS at, bracket FROM e WHERE (step < 0 AND depth < low) OR (step > 0 AND back < back_low)""")
def orphan_brackets(spark, sf_dir):
    return brackets.orphans(read(spark, sf_dir, "pages"), "page_id", "html", "<", ">").select("page_id", big("at").alias("at"), "bracket")


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN left(text, 12) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS label FROM conversations""")
def section_filldown(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").withColumn("own", F.when(F.col("role") == "user", F.left("text", F.lit(12))))
    return spans.fill_forward(rows, ["conv_id"], ["turn"], "own", "label").select("conv_id", "turn", "label")


@query("""SELECT conv_id // 2 AS doc, conv_id, turn, row_number() OVER (PARTITION BY conv_id // 2 ORDER BY conv_id, turn) AS para_no FROM conversations""")
def concat_renumber(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select(big(F.floor(F.col("conv_id") / 2)).alias("doc"), "conv_id", "turn")
    return html.joined_parts(rows, "doc", "conv_id", "turn").select("doc", "conv_id", "turn", big("para_no").alias("para_no"))


@query("""WITH v AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events WHERE event_type = 'view'),
  c AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events WHERE event_type = 'click')
  SELECT v.user_id, k, v.event_id AS view_id, c.event_id AS click_id FROM v JOIN c USING (user_id, k)""")
def kth_pairing(spark, sf_dir):
    side = lambda kind, name: read(spark, sf_dir, "events").where(F.col("event_type") == kind).select("user_id", F.col("event_id").alias(name))
    return spans.kth_pairs(side("view", "view_id"), side("click", "click_id"), ["user_id"], ["view_id"], ["click_id"]).select("user_id", big("k").alias("k"), "view_id", "click_id")


# Dates and state


@query("""SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS latest FROM events""")
def state_fill_forward(spark, sf_dir):
    rows = read(spark, sf_dir, "events").withColumn("own", F.when(F.col("event_type") == "purchase", F.col("value")))
    return spans.fill_forward(rows, ["user_id"], ["event_id"], "own", "latest").select("event_id", "user_id", "latest")


@query("""SELECT event_id, coalesce(value < max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS backward FROM events""")
def out_of_order_guard(spark, sf_dir):
    return dates.out_of_order(read(spark, sf_dir, "events"), ["user_id"], ["event_id"], "value").select("event_id", "backward")


_ERA_VALUES = ", ".join(f"({k}, '{n}', {a}, {b}, '{d}')" for k, (n, a, b, d) in enumerate(dates.ERAS))
_BOOK_VALUES = ", ".join(f"('{b}', '{d}')" for b, d in dates.BOOK_DYNASTIES)
_BOOKS = list(dict.fromkeys(b for b, _ in dates.BOOK_DYNASTIES))


@query(f"""WITH eras(k, era, start_ad, end_ad, dynasty) AS (VALUES {_ERA_VALUES}), allowed(book, dynasty) AS (VALUES {_BOOK_VALUES}),
  m AS (SELECT p_partkey, [{", ".join(f"'{b}'" for b in _BOOKS)}][(p_partkey % {len(_BOOKS)} + 1)::INT] AS book, e.era, p_size % 12 + 1 AS era_year FROM part JOIN eras e ON e.k = p_partkey % {len(dates.ERAS)})
  SELECT m.p_partkey, m.book, m.era, m.era_year::BIGINT AS era_year, min(e.start_ad + m.era_year - 1)::BIGINT AS year_ad
  FROM m JOIN eras e ON e.era = m.era JOIN allowed a ON a.book = m.book AND a.dynasty = e.dynasty
  WHERE m.era_year <= e.end_ad - e.start_ad + 1 GROUP BY ALL HAVING count(*) = 1""")
def era_resolve_unique(spark, sf_dir):
    at = lambda names, n: F.element_at(F.array(*map(F.lit, names)), (F.col("p_partkey") % n + 1).cast("int"))
    names = [n for n, *_ in dates.ERAS]
    m = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), at(_BOOKS, len(_BOOKS)).alias("book"), at(names, len(names)).alias("era"), (F.col("p_size") % 12 + 1).cast("int").alias("era_year"))
    got = dates.resolve_eras(m, dates.eras(spark), dates.book_dynasties(spark))
    return got.select(F.col("id").alias("p_partkey"), "book", "era", big("era_year").alias("era_year"), big("year_ad").alias("year_ad"))


@query("""WITH RECURSIVE e AS (SELECT user_id, event_id, event_type AS kind, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS k, 196 + event_id % 25 AS y FROM events),
  s AS (
    SELECT DISTINCT user_id, -1::BIGINT AS k, NULL::BIGINT AS event_id, NULL::VARCHAR AS kind, NULL::BIGINT AS doc_year, false AS doc_era, NULL::BIGINT AS here, false AS era, false AS back, NULL::BIGINT AS year_ad FROM events
    UNION ALL
    SELECT user_id, k, event_id, kind, CASE WHEN moves AND NOT now_back THEN now_here ELSE doc_year END, CASE WHEN moves AND NOT now_back THEN now_era ELSE doc_era END, now_here, now_era, now_back,
           CASE kind WHEN 'purchase' THEN y WHEN 'signup' THEN CASE WHEN era THEN y END WHEN 'click' THEN here + 1 WHEN 'error' THEN here - 1 ELSE here END
    FROM (SELECT *, CASE kind WHEN 'purchase' THEN coalesce(y < doc_year, false) ELSE back END AS now_back, CASE kind WHEN 'purchase' THEN y WHEN 'signup' THEN CASE WHEN era THEN y ELSE here END WHEN 'click' THEN here + 1 ELSE here END AS now_here,
                 CASE kind WHEN 'purchase' THEN true WHEN 'click' THEN era AND coalesce(here + 1 BETWEEN 196 AND 220, false) ELSE era END AS now_era, kind = 'purchase' OR (kind = 'signup' AND era) OR (kind = 'click' AND here IS NOT NULL) AS moves
          FROM (SELECT e.user_id, e.k, e.event_id, e.kind, e.y, doc_year, doc_era, CASE WHEN e.k % 10 = 0 THEN doc_year ELSE here END AS here, CASE WHEN e.k % 10 = 0 THEN doc_era ELSE era END AS era, e.k % 10 <> 0 AND back AS back
                FROM s JOIN e ON e.user_id = s.user_id AND e.k = s.k + 1)))
  SELECT user_id, k // 10 AS seg_idx, k % 10 AS at, CASE kind WHEN 'purchase' THEN 'absolute' WHEN 'signup' THEN 'bare_year' WHEN 'view' THEN 'bare_month' WHEN 'click' THEN 'next_year' ELSE 'prev_year' END AS resolution,
         year_ad, CASE WHEN kind <> 'purchase' AND event_id % 7 = 0 AND NOT back THEN 0.5::DOUBLE END AS confidence
  FROM s WHERE year_ad IS NOT NULL""")
def state_machine_full(spark, sf_dir):
    """Events as date mentions: each user is a document, every ten events a segment."""
    kinds = dict(zip(["purchase", "signup", "view", "click", "error"], ["absolute", "bare_year", "bare_month", "next_year", "prev_year"], strict=True))
    kind = F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair))[F.col("event_type")]
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    m = read(spark, sf_dir, "events").select(
        F.col("user_id").alias("doc"), (F.floor(place / 10)).cast("int").alias("seg_idx"), F.lit("").alias("seg_id"), (place % 10).cast("int").alias("at"), F.lit(1).alias("length"), kind.alias("kind"),
        F.lit("建安").alias("era"), F.lit(196).alias("start_ad"), F.lit(220).alias("end_ad"), (F.col("event_id") % 25 + 1).cast("int").alias("number"),
        F.lit(None).cast("string").alias("month_chinese"), F.lit(None).cast("int").alias("month_ordinal"), F.col("event_type").alias("surface"), (F.col("event_id") % 7 == 0).alias("flashback"),
    )
    return dates.resolve(m).select(F.col("doc").alias("user_id"), big("seg_idx").alias("seg_idx"), big("at").alias("at"), "resolution", big("year_ad").alias("year_ad"), "confidence")


# Publishing


@query("""SELECT year(o_orderdate)::BIGINT AS year_ad, count(*) AS n_events, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS labels, min(o_orderkey) AS first_order FROM orders GROUP BY 1""")
def timeline_group(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumn("year_ad", big(F.year("o_orderdate")))
    return orders.groupBy("year_ad").agg(F.count(F.lit(1)).alias("n_events"), F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("labels"), F.min("o_orderkey").alias("first_order"))


@query("""SELECT (year(o_orderdate) // 10 * 10)::BIGINT AS decade, count(DISTINCT year(o_orderdate)) AS n_years, count(*) AS n_events FROM orders GROUP BY 1""")
def decade_bucket(spark, sf_dir):
    years = read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return years.groupBy(numerals.decade(F.col("year")).alias("decade")).agg(F.count(F.lit(1)).alias("n_years"), F.sum("n").alias("n_events"))


@query("""SELECT user_id, count(*) AS n_events, count(*) FILTER (event_type IN ('view', 'click')) AS n_seen, count(*) FILTER (event_type = 'purchase') AS n_purchases, count(*) FILTER (event_type = 'error') AS n_errors FROM events GROUP BY user_id""")
def typed_counts(spark, sf_dir):
    kind = F.col("event_type")
    return read(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.count_if(kind.isin("view", "click")).alias("n_seen"), F.count_if(kind == "purchase").alias("n_purchases"), F.count_if(kind == "error").alias("n_errors"))


@query("""SELECT r_name, n_name, string_agg(c_name, ',' ORDER BY c_custkey) AS customers, count(*) AS n_customers
  FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey GROUP BY r_name, n_name""")
def nested_index(spark, sf_dir):
    people = read(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))).alias("list"))
    places = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return places.join(people, F.col("n_nationkey") == F.col("c_nationkey")).select("r_name", "n_name", F.array_join(F.transform("list", lambda c: c["c_name"]), ",").alias("customers"), big(F.size("list")).alias("n_customers"))


@query("""SELECT source, lang, arg_min(doc_id, doc_id) AS first_doc, arg_max(doc_id, n_chars * 1000000000 - doc_id) AS longest_doc, max(n_chars) AS n_chars FROM documents GROUP BY source, lang""")
def first_and_longest(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.min("doc_id").alias("first_doc"), F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("longest_doc"), F.max("n_chars").alias("n_chars"))


@query("""SELECT l_partkey, count(*) AS n_mentions, count(DISTINCT l_orderkey) AS n_orders FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_partkey % 7 = l.l_suppkey % 7) GROUP BY l_partkey""")
def mentions_excl_bio(spark, sf_dir):
    own = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_partkey") % 7).alias("home"))
    lines = read(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", (F.col("l_suppkey") % 7).alias("home"))
    return lines.join(own, ["l_partkey", "home"], "left_anti").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_mentions"), F.count_distinct("l_orderkey").alias("n_orders"))


@query("""SELECT name, arg_min(id, (id * 10 + o)) AS id FROM (SELECT p_name AS name, p_partkey AS id, 0 AS o FROM part UNION ALL SELECT p_brand, p_partkey, 1 FROM part UNION ALL SELECT p_type, p_partkey, 1 FROM part) GROUP BY name""")
def name_index_first_wins(spark, sf_dir):
    roster = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("rank"), F.col("p_partkey").alias("id"), F.col("p_name").alias("primary_name"), F.array("p_brand", "p_type").alias("aliases"))
    return publish.name_index(roster)


@query("""SELECT o_orderdate, lag(o_orderdate) OVER (ORDER BY o_orderdate) AS previous, lead(o_orderdate) OVER (ORDER BY o_orderdate) AS next FROM (SELECT DISTINCT o_orderdate::DATE::VARCHAR AS o_orderdate FROM orders)""")
def prev_next(spark, sf_dir):
    days = read(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")).distinct()
    w = Window.orderBy("o_orderdate")  # distinct days, a few thousand whatever the number of orders
    return days.select("o_orderdate", F.lag("o_orderdate").over(w).alias("previous"), F.lead("o_orderdate").over(w).alias("next"))


@query("""SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal >= 1000 AND contains(c_name, '7') AND (c_nationkey = 3 OR c_nationkey IS NULL OR c_nationkey <= 12) ORDER BY c_acctbal DESC, c_custkey LIMIT 50""")
def list_filters(spark, sf_dir):
    c = read(spark, sf_dir, "customer").where((F.col("c_acctbal") >= 1000) & F.contains("c_name", F.lit("7")) & F.coalesce(F.col("c_nationkey") <= 12, F.lit(True)))
    return c.orderBy(F.desc("c_acctbal"), "c_custkey").limit(50).select("c_custkey", "c_name", "c_acctbal")


@query("""SELECT p_partkey, p_name, matched_via FROM (
  SELECT p_partkey, p_name, 'primary_name' AS matched_via FROM part WHERE p_name = 'red widget' UNION ALL SELECT p_partkey, p_name, 'alias' FROM part WHERE 'red widget' IN (p_brand, p_type, reverse(p_name))
  UNION ALL SELECT p_partkey, p_name, 'given_name' FROM part WHERE split_part(p_name, ' ', 1) = 'red widget' UNION ALL SELECT p_partkey, p_name, 'courtesy_name' FROM part WHERE p_name || '' = 'red widget')""")
def resolve_name(spark, sf_dir):
    roster = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("rank"), F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("primary_name"), F.array("p_brand", "p_type", F.reverse("p_name")).alias("aliases"),
        F.create_map().cast("map<string,array<string>>").alias("chapter_aliases"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("given_name"), F.col("p_name").alias("courtesy_name"),
    )
    found = service.Corpus(None, None, None, roster).resolve_name("red widget")
    return found.select(F.col("rank").alias("p_partkey"), F.col("primary_name").alias("p_name"), "matched_via")


# Layers, alignment and checks


@query("""SELECT event_id, event_type, value FROM events WHERE event_type <> 'view' UNION ALL SELECT event_id, 'view', value * 2 FROM events WHERE event_type = 'view' AND event_id % 3 <> 0""")
def replace_by_type(spark, sf_dir):
    old = read(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("type"), "value")
    new = old.where("type = 'view' AND event_id % 3 <> 0").withColumn("value", F.col("value") * 2)
    return merge.replace_type(old, new, "view").select("event_id", F.col("type").alias("event_type"), "value")


@query("""WITH old AS (SELECT user_id, event_id AS at, user_id || '.h' || row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS id FROM events WHERE event_type = 'view'),
  last_ AS (SELECT user_id, count(*) AS n FROM old GROUP BY user_id),
  new_ AS (SELECT user_id, event_id AS at FROM events WHERE event_type IN ('click', 'view'))
  SELECT user_id, at, id FROM old UNION ALL
  SELECT user_id, at, user_id || '.h' || (coalesce(n, 0) + row_number() OVER (PARTITION BY user_id ORDER BY at)) FROM new_ LEFT JOIN last_ USING (user_id)
  WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.user_id = new_.user_id AND old.at = new_.at)""")
def append_id_continue(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("at"), "event_type")
    old = merge.with_ids(rows.where("event_type = 'view'").drop("event_type"), "user_id", "h", ["at"])
    return merge.append(old, rows.where(F.col("event_type").isin("click", "view")).drop("event_type"), "user_id", "h", ["at"]).select("user_id", "at", "id")


@query("""SELECT id, row_number() OVER (ORDER BY n, s) AS natural_place, row_number() OVER (ORDER BY id) AS lexical_place FROM (SELECT 'n.' || s_nationkey || '.p' || s_suppkey AS id, s_nationkey AS n, s_suppkey AS s FROM supplier)""")
def natural_vs_lex_sort(spark, sf_dir):
    ids = read(spark, sf_dir, "supplier").select(F.concat(F.lit("n."), "s_nationkey", F.lit(".p"), "s_suppkey").alias("id"))
    place = lambda *order: big(F.row_number().over(Window.orderBy(*order)))
    return ids.select("id", place(text.natural_key(F.col("id"))).alias("natural_place"), place("id").alias("lexical_place"))


@query(f"""WITH h AS (SELECT conv_id, turn, sha256(translate(regexp_replace(regexp_replace(text, '{SPACE}+', '', 'g'), '\\p{{P}}', '', 'g'), '', '')) AS h FROM conversations),
  l AS (SELECT *, row_number() OVER (PARTITION BY conv_id, h ORDER BY turn) AS k FROM h), r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, h ORDER BY turn) AS k FROM h WHERE turn <> 1)
  SELECT l.conv_id, l.turn AS left_no, r.turn AS right_no FROM l JOIN r USING (conv_id, h, k)""")
def align_hash_join(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    return align.align_by_hash(c, c.where("turn <> 1"), ["conv_id"], "turn").select("conv_id", "left_no", "right_no")


@query("""WITH n AS (SELECT conv_id, count(*) AS n_left, count(*) FILTER (turn <> 1) AS n_right FROM conversations GROUP BY conv_id)
  SELECT conv_id, n_left, n_right, n_right AS n_aligned, n_left - n_right AS n_left_over, 0::BIGINT AS n_right_over FROM n""")
def align_difflib(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    pairs = align.align(c, c.where("turn <> 1"), "conv_id", "turn")
    return align.summary(c, c.where("turn <> 1"), pairs, "conv_id").select("conv_id", *(big(n).alias(n) for n in ("n_left", "n_right", "n_aligned", "n_left_over", "n_right_over")))


@query("SELECT a.item_id, true AS round_trip, true AS valid FROM benchmark a JOIN benchmark b ON b.item_id = a.item_id + 1")
def diff_round_trip(spark, sf_dir):
    b = read(spark, sf_dir, "benchmark")
    pairs = b.select("item_id", F.col("text").alias("old")).join(b.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("new")), "item_id")
    done = align.edit_scripts(pairs, "old", "new")
    return done.select("item_id", (align.apply_script(F.col("old"), F.col("ops")) == F.col("new")).alias("round_trip"), align.script_error(F.col("old"), F.col("ops")).isNull().alias("valid"))


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'equal' WHEN 1 THEN CASE WHEN contains(text, '.') THEN 'variant_char' ELSE 'equal' END ELSE 'textual' END AS kind FROM documents""")
def classify_pairs(spark, sf_dir):
    t = F.col("text")
    other = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" "), t)).when(F.col("doc_id") % 3 == 1, F.replace(t, F.lit("."), F.lit(";"))).otherwise(F.concat(t, F.lit("x")))
    return read(spark, sf_dir, "documents").select("doc_id", align.classify(t, other).alias("kind"))


@query("""SELECT * FROM (
  SELECT doc_id::VARCHAR AS entity_id, unnest([CASE WHEN length(text) < 100 THEN 'short text' END, CASE WHEN lang NOT IN ('en', 'de') THEN 'other language' END, CASE WHEN n_chars <> length(text) THEN 'wrong size' END, CASE WHEN quality IS NULL THEN 'no label' END, CASE WHEN quality = 1 AND toxic = 1 THEN 'good but toxic' END]) AS rule
  FROM documents LEFT JOIN labels USING (doc_id)) WHERE rule IS NOT NULL""")
def validate_rules(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    c = F.col
    rules = [("short text", F.length("text") < 100), ("other language", ~c("lang").isin("en", "de")), ("wrong size", c("n_chars") != F.length("text")), ("no label", c("quality").isNull()), ("good but toxic", (c("quality") == 1) & (c("toxic") == 1))]
    return validate.violations(docs, c("doc_id"), rules)


@query("""SELECT doc_id, CASE WHEN text IS NULL THEN 'unknown segment' WHEN person IS NULL THEN 'no person' WHEN person NOT IN ('p1', 'p2', 'p3') THEN 'unknown person' WHEN size <= 0 THEN 'no span'
    WHEN at + size > length(text) THEN 'span outside the segment' WHEN substr(text, at + 1, size) <> surface THEN 'the span holds other text' WHEN confidence < 0.7 THEN 'low confidence' END AS reason
  FROM (SELECT l.doc_id, d.text, CASE WHEN l.doc_id % 11 = 0 THEN NULL ELSE 'p' || (l.doc_id % 5) END AS person, l.doc_id % 90 AS at, l.doc_id % 8 AS size,
               CASE WHEN l.doc_id % 6 = 0 THEN 'zzz' ELSE substr(d.text, l.doc_id % 90 + 1, l.doc_id % 8) END AS surface, (l.doc_id % 10) / 10.0 AS confidence
        FROM labels l LEFT JOIN (SELECT * FROM documents WHERE doc_id % 13 <> 0) d USING (doc_id))""")
def decision_validator(spark, sf_dir):
    d = read(spark, sf_dir, "labels").join(read(spark, sf_dir, "documents").where("doc_id % 13 <> 0").select("doc_id", "text"), "doc_id", "left")
    n = F.col("doc_id")
    d = d.select("doc_id", "text", F.when(n % 11 != 0, F.concat(F.lit("p"), n % 5)).alias("person_id"), (n % 90).cast("int").alias("at"), (n % 8).cast("int").alias("length"), ((n % 10) / 10).alias("confidence"))
    d = d.withColumn("surface", F.when(n % 6 == 0, "zzz").otherwise(F.substring(F.col("text"), F.col("at") + 1, F.col("length"))))
    return d.select("doc_id", validate.decision_error(F.col("text"), F.col("person_id").isin("p1", "p2", "p3")).alias("reason"))


@query("""SELECT doc_id, min(item_id) AS item_id FROM documents JOIN (SELECT item_id, split_part(text, '.', 1) AS token FROM benchmark) ON contains(text, token) GROUP BY doc_id HAVING count(DISTINCT item_id) = 1""")
def contains_theta_unique(spark, sf_dir):
    from ..operators.disambiguate import filled_from_reasoning

    roster = read(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("id"), F.split_part("text", F.lit("."), F.lit(1)).alias("primary_name"), F.array().cast("array<string>").alias("aliases"), F.create_map().cast("map<string,array<string>>").alias("chapter_aliases"), F.lit("").alias("brief"))
    open_ = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit("").alias("surface"), F.col("text").alias("reasoning"), F.lit(None).cast("string").alias("person_id"))
    return filled_from_reasoning(open_, roster).where("person_id IS NOT NULL").select(F.col("id").alias("doc_id"), big("person_id").alias("item_id"))


@query("""SELECT p_partkey, CASE WHEN k = 1 THEN stem ELSE stem || '_' || k END AS id FROM (SELECT p_partkey, replace(p_name, ' ', '') AS stem, row_number() OVER (PARTITION BY replace(p_name, ' ', '') ORDER BY p_partkey) AS k FROM part)""")
def collision_free_ids(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit("")).alias("stem"))
    return sinks.free_ids(parts, "stem", spark.createDataFrame([], "id string"), ["p_partkey"]).select("p_partkey", "id")


@query("""SELECT l_returnflag, l_linestatus, band, count(*) AS n FROM (SELECT l_returnflag, l_linestatus, CASE WHEN l_quantity >= 40 THEN '40+' WHEN l_quantity >= 20 THEN '20-39' WHEN l_quantity >= 10 THEN '10-19' ELSE '0-9' END AS band FROM lineitem) GROUP BY ALL""")
def bands(spark, sf_dir):
    band = publish.band(F.col("l_quantity"), [40, 20, 10, 0])
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus", band.alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT (SELECT count(*) FROM documents) AS n_documents, (SELECT count(DISTINCT year(o_orderdate)) FROM orders) AS n_years, (SELECT count(*) FROM events) AS n_events, (SELECT count(*) FROM customer) AS n_people")
def home_totals(spark, sf_dir):
    n = lambda t, what, name: read(spark, sf_dir, t).agg(what.alias(name)).withColumn("one", F.lit(1))
    one = F.count(F.lit(1))
    out = n("documents", one, "n_documents").join(n("orders", F.count_distinct(F.year("o_orderdate")), "n_years"), "one").join(n("events", one, "n_events"), "one").join(n("customer", one, "n_people"), "one")
    return out.drop("one")


# Streams


@query("SELECT date_trunc('day', ts)::DATE::VARCHAR AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def streaming_typed_counts(spark, sf_dir):
    """The whole table as a stream that ends when all is read, written by batch into the shared folder."""
    days = lambda s: jobs.typed_counts(s).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")
    return _streamed(spark, sf_dir, "counts", days, "complete")


@query("""SELECT event_id, coalesce(value < max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS backward FROM (SELECT user_id, event_id, floor(value)::INT AS value FROM events)""")
def streaming_clock(spark, sf_dir):
    rows = lambda s: jobs.clocks(s.select(F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("place"), F.floor("value").cast("int").alias("year"))).select(F.col("place").alias("event_id"), "backward")
    return _streamed(spark, sf_dir, "clock", rows, "append", per_trigger=None)  # a table's files have no order in time


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
  s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g)
  SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS ends_at, count(*) AS n FROM s GROUP BY user_id, session""")
def carried_sessions(spark, sf_dir):
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    found = jobs.carried_sessions(read(spark, sf_dir, "events").select("user_id", "ts"))
    return found.select("user_id", at("start").alias("first_at"), at("end").alias("ends_at"), "n")


def _streamed(spark: SparkSession, sf_dir: str, name: str, plan, mode: str, per_trigger: int | None = 100) -> DataFrame:
    import uuid

    root = f"{jobs.shared_folder(spark)}/stream-{name}-{uuid.uuid4().hex}"
    stream = jobs.new_files(spark, f"{sf_dir}/events.parquet*", read(spark, sf_dir, "events").schema, per_trigger)
    jobs.run_once(plan(stream), f"{root}/out", f"{root}/state", mode)
    return spark.read.parquet(f"{root}/out")


QUERIES |= corpus_queries.QUERIES
ORACLE |= corpus_queries.ORACLE
