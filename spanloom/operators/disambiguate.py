"""Requests about ambiguous titles and the decisions that come back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import snippet
from .merge import append
from .spans import words_in
from .validate import decision_error


#: Words in a person's description that fit an ambiguous title.
ROLE_WORDS = {
    "太子": ["太子", "嗣子", "皇太子"],
    "太后": ["太后", "皇后", "夫人", "皇太后"],
    "皇后": ["皇后", "夫人", "貴人", "美人"],
    "陛下": ["皇帝", "帝", "皇", "天子", "公"],
    "主上": ["皇帝", "帝", "皇", "主", "公"],
    "王后": ["皇后", "夫人", "王后"],
}


def requests(titles: DataFrame, segments: DataFrame, roster: DataFrame) -> DataFrame:
    """(doc, request): a JSON request for each chapter that has unresolved titles."""
    people = roster.select("id", "primary_name", F.coalesce("courtesy_name", F.lit("")).alias("courtesy_name"), "aliases", "brief")
    marked = titles.join(segments.select("seg_id", "text"), "seg_id").withColumn("snippet", snippet(F.col("text"), F.col("at"), 25, 25))
    per = marked.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("title_no", "seg_id", "at", "surface", "snippet"))).alias("markers"))
    listed = people.agg(F.array_sort(F.collect_list(F.struct(*people.columns))).alias("roster"))
    return per.join(F.broadcast(listed), F.lit(True), "left").select("doc", F.to_json(F.struct("doc", "markers", "roster"), {"ignoreNullFields": "true"}).alias("request"))


def checked(decisions: DataFrame, segments: DataFrame, roster: DataFrame, taken: DataFrame, least: float = 0.7) -> DataFrame:
    """decisions with status accepted, duplicate or rejected, and the reason.

    decisions: anchor, at, length, surface, person_id, confidence, reasoning; taken: anchor and at of the spans that exist.
    """
    full = decisions.join(segments.select(F.col("seg_id").alias("anchor"), "text"), "anchor", "left")
    full = full.join(roster.select(F.col("id").alias("person_id"), F.lit(True).alias("known")), "person_id", "left")
    full = full.join(taken.select("anchor", "at", F.lit(True).alias("taken")).distinct(), ["anchor", "at"], "left")
    full = full.withColumn("reason", decision_error(F.col("text"), F.coalesce("known", F.lit(False)), least))
    first = Window.partitionBy("anchor", "at", F.col("reason").isNull()).orderBy(F.desc("confidence"), "person_id")
    again = F.col("taken").isNotNull() | (F.row_number().over(first) > 1)
    status = F.when(F.col("reason").isNotNull(), "rejected").when(again, "duplicate").otherwise("accepted")
    return full.withColumn("status", status).drop("text", "known", "taken")


def merged(annotations: DataFrame, decided: DataFrame) -> DataFrame:
    """annotations and the accepted decisions as person rows with ids that go on behind each segment's last."""
    chapter = F.regexp_extract("anchor", "^(.*)\\.p\\d+[a-z]*$", 1)
    new = decided.where("status = 'accepted'").select(chapter.alias("chapter"), "anchor", "at", "length", F.lit("person").alias("type"), F.col("surface").alias("text"), "person_id", "confidence", "reasoning", F.lit("llm").alias("via"))
    people = annotations.where("type = 'person'")
    return annotations.where("type <> 'person'").unionByName(append(people, new, "anchor", "h", ["at"]), allowMissingColumns=True)


def lookup(roster: DataFrame) -> DataFrame:
    """(person_id, token, brief): every name of at least two characters."""
    names = F.array_distinct(F.concat(F.array("primary_name"), "aliases", F.flatten(F.map_values("chapter_aliases"))))
    return roster.select(F.col("id").alias("person_id"), F.explode(F.filter(names, lambda n: F.length(n) >= 2)).alias("token"), "brief")


def filled_from_reasoning(decisions: DataFrame, roster: DataFrame, roles: dict[str, list[str]] | None = None) -> DataFrame:
    """decisions with the person that their reasoning names, where it was missing and exactly one person fits.

    decisions has `id`. Where a surface has role words, a person's description or name must hold one of them. Names of the roster,
    a curated table, are found in one pass over the text and joined by name.
    """
    open_ = decisions.where("person_id IS NULL").select("id", "surface", "reasoning")
    fits = F.lit(True)
    for surface, words in (roles or {}).items():
        any_ = F.lit(False)
        for w in words:
            any_ = any_ | F.contains(F.concat_ws(" ", "brief", "token"), F.lit(w))
        fits = fits & ((F.col("surface") != surface) | any_)
    names = lookup(roster)
    found = words_in(open_, "reasoning", [r.token for r in names.select("token").distinct().collect()], "token")
    hits = found.join(names, "token").where(fits)
    one = hits.groupBy("id").agg(F.count_distinct("person_id").alias("n"), F.min("person_id").alias("found")).where("n = 1")
    return decisions.join(one.select("id", "found"), "id", "left").withColumn("person_id", F.coalesce("person_id", "found")).drop("found")
