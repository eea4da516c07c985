"""Names of people in segments: roster matching, given names, carried given names, unresolved titles, introductions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .spans import alternation, carry, find_all, greedy_spans, occurrences, words_in

WINDOW = 8
#: Titles that name different people in different places.
TITLES = ["太子", "太后", "皇后", "陛下", "主上", "王后"]


#: What looks like a name before a courtesy name but is none.
NOT_NAMES = "列女 良吏 酷吏 宦者 獨行 方術 逸民 文苑 儒林 黨錮 西羌 南蠻 東夷 西域 鮮卑 烏丸 其後 其子 之子 之孫 其孫 之父 楚王彪 燕王宇 陳羣".split()


def patterns(roster: DataFrame, book: str) -> DataFrame:
    """(surface, person_id, via): what names a person in a book. Where several share a surface, the first in the roster's order.

    roster has rank, id, primary_name, aliases and chapter_aliases (a map of arrays by book).
    """
    name = lambda via, order, surface: roster.select(F.lit(via).alias("via"), F.lit(order).alias("order"), "rank", F.col("id").alias("person_id"), surface.alias("surface"))
    all_ = name("primary", 0, F.col("primary_name")).unionByName(name("alias", 1, F.explode("aliases"))).unionByName(name("chapter_alias", 2, F.explode(F.col("chapter_aliases")[book])))
    first = Window.partitionBy("surface").orderBy("rank", "order")
    return all_.where("length(surface) > 0").withColumn("n", F.row_number().over(first)).where("n = 1").select("surface", "person_id", "via")


def named(segments: DataFrame, roster: DataFrame) -> DataFrame:
    """Spans of names, leftmost and longest first, for segments (doc, seg_idx, seg_id, book, text).

    The roster is curated and small: its names become one pattern per book.
    """
    books = [r[0] for r in segments.select("book").distinct().collect()]
    out = None
    for book in sorted(b for b in books if b is not None):
        rows = patterns(roster, book).collect()
        rx = alternation([r.surface for r in rows])
        if rx:
            spans = segments.where(F.col("book") == book).select("doc", "seg_idx", "seg_id", F.inline(find_all(F.col("text"), rx))).join(F.broadcast(segments.sparkSession.createDataFrame(rows, "surface string, person_id string, via string")), "surface")
            out = spans if out is None else out.unionByName(spans)
    spark: SparkSession = segments.sparkSession
    empty = spark.createDataFrame([], "surface string, doc string, seg_idx int, seg_id string, at int, length int, person_id string, via string")
    return (out if out is not None else empty).select("doc", "seg_idx", "seg_id", "at", "length", "surface", "person_id", "via")


def given_names(segments: DataFrame, roster: DataFrame, spans: DataFrame) -> DataFrame:
    """Occurrences of given names that start in no name's span and are not part of a blocked word."""
    people = roster.where("given_name IS NOT NULL").select(F.col("id").alias("person_id"), F.col("given_name").alias("surface"), F.coalesce("given_name_blockers", F.array().cast("array<string>")).alias("blockers"))
    found = words_in(segments.select("doc", "seg_idx", "seg_id", "text"), "text", [r.surface for r in people.select("surface").distinct().collect()])
    at = found.join(people, "surface").select("doc", "seg_idx", "seg_id", "text", "person_id", "surface", "blockers", F.explode(occurrences(F.col("text"), F.col("surface"))).alias("at"))
    n = F.length("surface")
    left = (F.col("at") > 0) & F.array_contains("blockers", F.substring(F.col("text"), F.col("at"), n + 1))
    right = F.array_contains("blockers", F.substring(F.col("text"), F.col("at") + 1, n + 1)) & (F.col("at") + n + 1 <= F.length("text"))
    free = at.where(~(left | right)).select("doc", "seg_idx", "seg_id", "at", n.alias("length"), "surface", "person_id")
    o = spans.select(F.col("doc").alias("_d"), F.col("seg_idx").alias("_i"), F.col("at").alias("_a"), (F.col("at") + F.col("length")).alias("_b"))
    return free.join(o, (free["doc"] == o["_d"]) & (free["seg_idx"] == o["_i"]) & (free["at"] >= o["_a"]) & (free["at"] < o["_b"]), "left_anti")


def person_spans(segments: DataFrame, roster: DataFrame, window: int = WINDOW) -> DataFrame:
    """All spans of people: names, given names beside a name in the segment, and given names carried from segments before."""
    keys = ["doc", "seg_idx", "seg_id"]
    names = named(segments, roster)
    free = given_names(segments, roster, names)
    here = names.select("doc", "seg_idx", "person_id").distinct()
    beside = free.join(here, ["doc", "seg_idx", "person_id"], "left_semi").withColumn("via", F.lit("given_name"))
    own = greedy_spans(names.unionByName(beside.select(names.columns)), keys)
    waiting = free.join(own.select("doc", "seg_idx", F.col("at").alias("_a"), (F.col("at") + F.col("length")).alias("_b")).alias("o"), ["doc", "seg_idx"], "left")
    waiting = waiting.groupBy(*keys, "at", "length", "surface", "person_id").agg(F.coalesce(F.bool_or((F.col("at") >= F.col("_a")) & (F.col("at") < F.col("_b"))), F.lit(False)).alias("covered")).where("NOT covered").drop("covered")
    anchors = own.select("doc", "seg_idx", "person_id").distinct().withColumn("anchor", F.lit(True))
    steps = anchors.unionByName(waiting.select("doc", "seg_idx", "person_id").distinct().join(anchors, ["doc", "seg_idx", "person_id"], "left_anti").withColumn("anchor", F.lit(False)))
    carried = carry(steps, ["doc", "person_id"], "seg_idx", window).select("doc", "seg_idx", "person_id")
    late = waiting.join(carried, ["doc", "seg_idx", "person_id"], "left_semi").withColumn("via", F.lit("given_name_carry"))
    return greedy_spans(own.unionByName(late.select(own.columns)), keys)


def unresolved_titles(segments: DataFrame, spans: DataFrame, titles: list[str] = TITLES) -> DataFrame:
    """Occurrences of ambiguous titles that start inside no person's span, by title and then place."""
    order = F.array_position(F.array(*map(F.lit, titles)), F.col("surface"))
    hits = None
    for t in titles:
        one = segments.where(F.contains("text", F.lit(t))).select("doc", "seg_idx", "seg_id", F.lit(t).alias("surface"), F.explode(occurrences(F.col("text"), t)).alias("at"))
        hits = one if hits is None else hits.unionByName(one)
    o = spans.select(F.col("doc").alias("_d"), F.col("seg_idx").alias("_i"), F.col("at").alias("_a"), (F.col("at") + F.col("length")).alias("_b"))
    kept = hits.join(o, (hits["doc"] == o["_d"]) & (hits["seg_idx"] == o["_i"]) & (hits["at"] >= o["_a"]) & (hits["at"] < o["_b"]), "left_anti")
    return kept.withColumn("title_no", order.cast("int"))


def introductions(segments: DataFrame, known: DataFrame, least: int = 2, blocked: list[str] = NOT_NAMES) -> DataFrame:
    """People who are introduced as `name字courtesy` between marks and are not known yet.

    Per (name, courtesy): introductions, occurrences of the name in the chapters that introduce it, and these chapters in order.
    """
    edge = "[，。；：、！？「」『』\\s]"
    rx = f"(?:^|(?<={edge}))[\\x{{4E00}}-\\x{{9FFF}}]{{2,3}}字[\\x{{4E00}}-\\x{{9FFF}}]{{2}}(?=$|{edge})"
    hits = segments.select("doc", F.explode(F.regexp_extract_all("text", F.lit(rx), 0)).alias("hit"))
    hits = hits.select("doc", F.regexp_extract("hit", "^(.+)字(..)$", 1).alias("name"), F.regexp_extract("hit", "^(.+)字(..)$", 2).alias("courtesy"))
    hits = hits.where(~F.col("name").isin(list(blocked) or [""])).join(known.select("name"), "name", "left_anti")
    per = hits.groupBy("doc", "name", "courtesy").agg(F.count(F.lit(1)).alias("n_introduced"))
    chapters = segments.join(per.select("doc").distinct(), "doc", "left_semi")
    seen = per.join(chapters.select("doc", "text"), "doc").groupBy("doc", "name", "courtesy", "n_introduced").agg(F.sum((F.length("text") - F.length(F.replace("text", F.col("name")))) / F.length("name")).cast("long").alias("n_in_doc"))
    out = seen.groupBy("name", "courtesy").agg(F.sum("n_introduced").alias("n_introduced"), F.sum("n_in_doc").alias("n_occurrences"), F.array_sort(F.collect_list("doc")).alias("docs"))
    return out.where(F.col("n_occurrences") >= least)


def outside(spans: DataFrame, excluded: DataFrame) -> DataFrame:
    """Spans (doc, seg_idx, at, length) that overlap no excluded one, such as names inside dates."""
    from .spans import overlap_anti

    ends = lambda df: df.withColumn("end", F.col("at") + F.col("length"))
    return overlap_anti(ends(spans), ends(excluded), ["doc", "seg_idx"]).drop("end")
