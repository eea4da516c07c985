"""Chapters in web pages of two layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import HAN, has_min, normalize_title, plain, strip_space, strip_tags, unescape, unescape_basic

#: The class of a page's text container, and what stands behind the text.
CONTAINER = "mw-parser-output"
BEHIND = ['<div class="printfooter"', '<div id="catlinks"']


def wiki_body(page: Column) -> Column:
    """What the text container holds, up to the first thing behind the text; empty where there is no container."""
    inside = F.get(F.split(page, f"<div\\b[^>]*[\"\\s]{CONTAINER}[\"\\s][^>]*>", 2), F.lit(1))
    for mark in BEHIND:
        inside = F.get(F.split(inside, f"\\Q{mark}\\E", 2), F.lit(0))
    return F.coalesce(inside, F.lit(""))


def headings_as_paragraphs(body: Column) -> Column:
    """For works whose headings and preformatted blocks are text: rewritten as paragraphs, paragraph numbers dropped."""
    body = F.regexp_replace(body, "<(?:h2|h3|h4|pre)\\b[^>]*>", "<p>")
    return F.regexp_replace(F.regexp_replace(body, "</(?:h2|h3|h4|pre)>", "</p>"), "<b>\\d+</b>", "")


def paragraphs(pages: DataFrame, key: str, body: Column, chars: str = HAN, least: int = 5, notice: str = "公有領域") -> DataFrame:
    """(key, para_no, text): paragraphs with enough characters that are not a notice, numbered after filtering."""
    found = pages.select(key, F.posexplode(F.regexp_extract_all(body, F.lit("(?s)<p\\b[^>]*>(.*?)</p>"), 1)).alias("pos", "raw")).withColumn("text", plain(F.col("raw")))
    kept = found.where(has_min(F.col("text"), chars, least) & ~F.contains("text", F.lit(notice)))
    return kept.select(key, F.row_number().over(Window.partitionBy(key).orderBy("pos")).alias("para_no"), "text")


def wiki_title(page: Column) -> Column:
    from ..functions.text import first_title_line

    return normalize_title(first_title_line(page, ["魏書", "蜀書", "吳書", "呉書", "吴書"]))


def table_rows(pages: DataFrame, key: str, page: str = "html") -> DataFrame:
    """(key, row, display_no, section, node_id, raw): rows of the layout with one paragraph per table row.

    A section's label stands at its first row and holds until the next one.
    """
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(page, F.lit("(?s)<tr\\b[^>]*>(.*?)</tr>"), 1)).alias("row", "tr"))
    cell = F.regexp_extract("tr", '(?s)<td class="ctext">(.*?)</td>', 1)
    label = F.nullif(plain(F.regexp_extract("tr", '(?s)<td class="ctext opt">(.*?)</td>', 1)), F.lit(""))
    rows = rows.select(key, "row", "tr", cell.alias("raw"), label.alias("label"), F.regexp_extract("tr", 'href="[^"]*?/(\\d+)"', 1).alias("display_no"), F.regexp_extract("tr", '<div id="(comm\\d+)"', 1).alias("node_id"))
    filled = F.last("label", ignorenulls=True).over(Window.partitionBy(key).orderBy("row").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("section", filled).where("length(raw) > 0").drop("tr", "label")


def wrong_juan(page: Column, expected: Column) -> Column:
    """What is wrong where a page's paragraph links lead to another chapter than expected, else null."""
    said = F.nullif(F.regexp_extract(page, 'href="[^"]*?/(\\d+)/\\d+"', 1), F.lit(""))
    return F.when(said.cast("int") != expected, F.concat(F.lit("links lead to chapter "), said))


def is_contents_page(page: Column) -> Column:
    return ~F.contains(page, F.lit('<td class="ctext">'))


def section_title(rows: DataFrame, key: str) -> DataFrame:
    """(key, title): the sections in order of first appearance, joined."""
    first = rows.where("section IS NOT NULL").groupBy(key, "section").agg(F.min("row").alias("row"))
    return first.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "section"))), lambda s: s["section"]), "、").alias("title"))


#: Signs that decoded text may hold, as private characters while tags are still there.
_SIGNS = [("<", "\ue000", "&(?:lt|LT|#0*60|#[xX]0*3[cC]);?"), (">", "\ue001", "&(?:gt|GT|#0*62|#[xX]0*3[eE]);?")]


def inline_comments(raw: Column) -> Column:
    """(main, notes) of a cell with `span.inlinecomment` notes; a note's place is the length of the main text before it."""
    for _, private, rx in _SIGNS:
        raw = F.regexp_replace(raw, rx, private)
    parts = F.split(unescape(raw), '(?s)<span class="inlinecomment">', -1)
    bare = lambda x: F.translate(strip_space(strip_tags(x)), "".join(p for _, p, _ in _SIGNS), "".join(s for s, _, _ in _SIGNS))

    def step(s: Column, part: Column) -> Column:
        pieces = F.split(part, "</span>", 2)
        note, rest = bare(F.get(pieces, F.lit(0))), bare(F.coalesce(F.get(pieces, F.lit(1)), F.lit("")))
        return F.struct(F.concat(s["main"], rest).alias("main"), F.array_append(s["notes"], F.struct(F.length(s["main"]).cast("int").alias("at"), note.alias("text"))).alias("notes"))

    first = F.struct(bare(F.get(parts, F.lit(0))).alias("main"), F.array().cast("array<struct<at:int,text:string>>").alias("notes"))
    return F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), first, step)


def joined_parts(parts: DataFrame, group: str, part: str, order: str) -> DataFrame:
    """Paragraphs of several parts as one document, numbered anew."""
    return parts.withColumn("para_no", F.row_number().over(Window.partitionBy(group).orderBy(part, order)))


def visible_text(page: Column) -> Column:
    """A page's text without scripts, styles and tags, entities decoded, white space single."""
    bare = F.regexp_replace(page, "(?is)<script\\b.*?</script>|<style\\b.*?</style>", " ")
    return F.trim(F.regexp_replace(unescape_basic(F.regexp_replace(bare, "<[^>]+>", " ")), "[ \\t\\r\\n]+", " "))


__all__ = ["headings_as_paragraphs", "inline_comments", "is_contents_page", "joined_parts", "paragraphs", "section_title", "strip_tags", "table_rows", "visible_text", "wiki_body", "wiki_title"]
