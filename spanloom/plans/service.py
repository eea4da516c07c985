"""Questions to a corpus. Each answer is a DataFrame; `Corpus` names the tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import snippet
from ..operators import publish
from ..operators.spans import occurrences

DEFAULT_LIMIT, MAX_LIMIT = 50, 500


class QueryError(Exception):
    """code: not_found, invalid_input, ambiguous or internal."""

    def __init__(self, code: str, message: str):
        super().__init__(message)
        self.code = code

    def envelope(self) -> dict:
        return {"error": {"code": self.code, "message": str(self)}}


@dataclass
class Corpus:
    segments: DataFrame  # doc, seg_idx, seg_id, text
    annotations: DataFrame
    chapters: DataFrame  # doc, work, book, juan, title
    roster: DataFrame

    def list_chapters(self, work: str | None = None, book: str | None = None) -> DataFrame:
        found = self._chapters(work, book)
        return found.join(publish.chapter_counts(self.segments, self.annotations), "doc", "left").orderBy("work", "book", "juan")

    def _chapters(self, work: str | None, book: str | None) -> DataFrame:
        found = self.chapters
        for name, value in (("work", work), ("book", book)):
            if value is not None:
                found = found.where(F.col(name) == value)
        return found

    def get_chapter(self, doc: str, include_annotations: bool = True, types: list[str] | None = None) -> DataFrame:
        if self.chapters.where(F.col("doc") == doc).isEmpty():
            raise QueryError("not_found", f"no chapter {doc}")
        own = self.annotations.where(F.col("chapter") == doc)
        own = own.where(F.lit(False)) if not include_annotations else own.where(F.col("type").isin(types)) if types else own
        return publish.chapter_docs(self.segments.where(F.col("doc") == doc), own)

    def get_segment(self, seg_id: str) -> DataFrame:
        found = self.segments.where(F.col("seg_id") == seg_id)
        if found.isEmpty():
            raise QueryError("not_found", f"no segment {seg_id}")
        return found

    def search_text(self, query: str, work: str | None = None, book: str | None = None, case_sensitive: bool = False, limit: int | None = DEFAULT_LIMIT, snippet_chars: int = 80) -> DataFrame:
        """Every occurrence of a literal string, the first `limit` of them, or all where it is None; n_total counts all."""
        if not query or (limit is not None and not 1 <= limit <= MAX_LIMIT):
            raise QueryError("invalid_input", "the query is empty" if not query else f"the limit must be 1 to {MAX_LIMIT}")
        return search(self.segments.join(self._chapters(work, book), "doc"), query, ["doc", "seg_idx", "seg_id"], case_sensitive, limit, snippet_chars)

    def list_persons(self, limit: int = DEFAULT_LIMIT, min_mentions: int = 0, name_contains: str | None = None, alive_in_year: int | None = None) -> DataFrame:
        found = publish.people_index(self.roster, self._mentions()).where(F.col("n_mentions") >= min_mentions)
        if name_contains is not None:
            found = found.where(F.contains("primary_name", F.lit(name_contains)) | F.exists("aliases", lambda a: F.contains(a, F.lit(name_contains))))
        if alive_in_year is not None:
            found = found.where(F.coalesce(F.col("birth_ad") <= alive_in_year, F.lit(True)) & F.coalesce(F.col("death_ad") >= alive_in_year, F.lit(True)))
        return found.orderBy(F.desc("n_mentions"), "id").limit(limit)

    def _mentions(self) -> DataFrame:
        return publish.mentions(self.annotations, self.segments, self.chapters, self.roster)

    def get_person(self, person_id: str, include_mentions: bool = True) -> DataFrame:
        who = self.roster.where(F.col("id") == person_id)
        if who.isEmpty():
            raise QueryError("not_found", f"no person {person_id}")
        own = publish.mentions(self.annotations.where(F.col("person_id") == person_id), self.segments, self.chapters, who)
        counted = publish.people_index(who, own)
        if not include_mentions:
            return counted
        rows = own.groupBy(F.col("person_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("place", "work", "chapter", "anchor", "at", "text", "via", "snippet"))).alias("mentions"))
        return counted.join(rows, "id", "left")

    def find_mentions(self, person_id: str, exclude_bio: bool = True, limit: int = DEFAULT_LIMIT) -> DataFrame:
        who = self.roster.where(F.col("id") == person_id)
        who = who if exclude_bio else who.withColumn("bio_chapters", F.array().cast("array<string>"))
        return publish.mentions(self.annotations.where(F.col("person_id") == person_id), self.segments, self.chapters, who).orderBy("place").limit(limit)

    def resolve_name(self, name: str, context_chapter: str | None = None) -> DataFrame:
        """People whom a name may mean, with what it is of them."""
        if not name:
            raise QueryError("invalid_input", "the name is empty")
        is_ = lambda c: F.col(c) == name
        book = (context_chapter or "").partition(".")[0]
        in_book = F.array_contains(F.coalesce(F.try_element_at("chapter_aliases", F.lit(book)), F.array()), name) if book else F.exists(F.map_values("chapter_aliases"), lambda a: F.array_contains(a, name))
        ways = [("primary_name", is_("primary_name")), ("alias", F.array_contains("aliases", name)), ("chapter_alias", in_book), ("given_name", is_("given_name")), ("courtesy_name", is_("courtesy_name"))]
        matched = F.filter(F.array(*(F.when(cond, F.lit(way)) for way, cond in ways)), lambda w: w.isNotNull())
        return self.roster.select("rank", "id", "primary_name", F.explode(matched).alias("matched_via")).orderBy("rank")

    def one_person(self, name: str, context_chapter: str | None = None) -> str:
        """The id of the one person whom a name means there."""
        found = [r.id for r in self.resolve_name(name, context_chapter).select("id").distinct().orderBy("id").limit(11).collect()]
        if not found:
            raise QueryError("not_found", f"nobody is called {name}")
        if len(found) > 1:
            raise QueryError("ambiguous", f"{name} may be {', '.join(found[:10])}")
        return found[0]

    def statistics(self) -> DataFrame:
        """How much there is: chapters, segments, years, dates and people, one row."""
        dated = self.annotations.where("type = 'temporal'").agg(F.count_distinct("year_ad").alias("n_years"), F.count(F.lit(1)).alias("n_dates"))
        one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
        return one(self.chapters, "n_chapters").crossJoin(one(self.segments, "n_segments")).crossJoin(dated).crossJoin(one(self.roster, "n_people"))  # of one row each

    def cached(self) -> Corpus:
        """The same corpus with its tables kept in memory once they are read; what fails is not kept."""
        return Corpus(*(df.persist() for df in (self.segments, self.annotations, self.chapters, self.roster)))

    def prompt(self, kind: str, **what) -> str:
        """A prompt of PROMPTS about a chapter, a person or a year, with the text that it needs."""
        if kind not in PROMPTS:
            raise QueryError("invalid_input", f"no prompt {kind}")
        if kind == "summarize_chapter":
            rows = [(s["seg_id"], s["text"]) for r in self.get_chapter(what["chapter"], False).collect() for s in r.segments]
        elif kind == "biography":
            who = self.one_person(what["name"], what.get("chapter"))
            rows = [(r.anchor, r.snippet) for r in self.find_mentions(who, exclude_bio=False, limit=MAX_LIMIT).collect()]
        else:
            rows = [(e["anchor"], e["snippet"]) for r in self.get_year(int(what["year"])).collect() for e in r.events]
        return PROMPTS[kind].format(**what, text="\n".join(f"[{i}] {t}" for i, t in rows))

    def get_year(self, year: int, work: str | None = None) -> DataFrame:
        events = publish.timeline_events(self.annotations.where(F.col("year_ad") == year), self.segments, self._chapters(work, None))
        return publish.timeline_years(events)

    def list_years(self, first: int | None = None, last: int | None = None) -> DataFrame:
        found = self.annotations.where("type = 'temporal'")
        found = found if first is None else found.where(F.col("year_ad") >= first)
        found = found if last is None else found.where(F.col("year_ad") <= last)
        years = found.groupBy("year_ad").agg(F.count(F.lit(1)).alias("n_events"))
        w = Window.orderBy("year_ad")  # a few hundred years
        return years.withColumns({"previous": F.lag("year_ad").over(w), "next": F.lead("year_ad").over(w)}).orderBy("year_ad")

    def resource(self, uri: str) -> DataFrame:
        """chapter://id, person://id, year://n and index://chapters, index://people, index://years."""
        kind, _, name = uri.partition("://")
        if kind == "year" and not name.lstrip("-").isdigit():
            raise QueryError("invalid_input", f"no year: {name}")
        ways = {"chapter": lambda: self.get_chapter(name), "person": lambda: self.get_person(name), "year": lambda: self.get_year(int(name)), "index": lambda: {"chapters": self.list_chapters, "people": lambda: self.list_persons(MAX_LIMIT), "years": self.list_years}[name]()}
        try:
            return ways[kind]()
        except KeyError:
            raise QueryError("not_found", f"no resource {uri}") from None


def route(address: str) -> tuple[str, dict[str, str]]:
    """The view that an address after `#/` names, and its parameters; what is unknown is the home view."""
    path, _, anchor = address.removeprefix("#").strip("/").partition("#")
    parts = [p for p in path.split("/") if p]
    views = {"chapter": ["book", "juan"], "person": ["id"], "year": ["year"]}
    if parts and parts[0] in views and len(parts) == 1 + len(views[parts[0]]):
        return parts[0], dict(zip(views[parts[0]], parts[1:], strict=True)) | ({"anchor": anchor} if anchor else {})
    if len(parts) == 1 and parts[0] in ("people", "timeline", "chapters"):
        return parts[0], {}
    return "home", {}


def search(rows: DataFrame, query: str, order: list[str], case_sensitive: bool = False, limit: int | None = DEFAULT_LIMIT, snippet_chars: int = 80) -> DataFrame:
    """Occurrences of a literal in rows with text: order columns, at, snippet and n_total."""
    text = F.col("text") if case_sensitive else F.lower("text")
    word = query if case_sensitive else query.lower()
    hit = rows.where(F.contains(text, F.lit(word))).withColumn("places", occurrences(text, word))
    total = hit.agg(F.coalesce(F.sum(F.size("places")), F.lit(0)).alias("n_total"))
    half = snippet_chars // 2
    found = hit.select(*order, F.explode("places").alias("at"), "text").withColumn("snippet", snippet(F.col("text"), F.col("at"), half, half)).drop("text")
    found = found.orderBy(*order, "at")
    found = found if limit is None else found.limit(limit)
    return found.join(F.broadcast(total), F.lit(True), "left")  # one row


#: Prompt templates for a language model, filled by Corpus.prompt; nothing here calls one.
PROMPTS = {
    "summarize_chapter": "Summarise chapter {chapter} from its segments and cite segment ids:\n{text}",
    "biography": "Write a short biography of {name} from these mentions and cite segment ids:\n{text}",
    "events_in_year": "List what happened in AD {year} by work and cite segment ids:\n{text}",
}
