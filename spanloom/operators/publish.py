"""Published views: timelines, people, chapters and their indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import snippet

#: The order of works in timelines and mentions; any other comes last.
WORK_ORDER = {"zztj": 0, "sanguozhi": 1, "houhanshu": 2}


def work_rank(work: Column) -> Column:
    rank = F.lit(99)
    for name, n in WORK_ORDER.items():
        rank = F.when(work == name, n).otherwise(rank)
    return rank


def timeline_events(annotations: DataFrame, segments: DataFrame, chapters: DataFrame) -> DataFrame:
    """Dates with their snippet and `place`, their position within the year.

    annotations: temporal rows; segments: seg_id, text; chapters: doc, work, book, juan, title. A missing segment gives an empty snippet, a missing chapter drops the date.
    """
    dated = annotations.where("type = 'temporal'").join(segments.select(F.col("seg_id").alias("anchor"), F.col("text").alias("whole")), "anchor", "left")
    dated = dated.join(chapters.select(F.col("doc").alias("chapter"), "work", "book", "juan", "title"), "chapter")
    order = [work_rank(F.col("work")), F.when(F.coalesce("kind", F.lit("absolute")) == "absolute", 0).otherwise(1), "book", "juan", "anchor", "at"]
    place = F.row_number().over(Window.partitionBy("year_ad").orderBy(*order))
    return dated.withColumn("snippet", snippet(F.coalesce("whole", F.lit("")), F.col("at"))).withColumn("place", place).drop("whole")


def timeline_years(events: DataFrame) -> DataFrame:
    """Per year: number of events, era labels in order, and the events."""
    label = F.when(F.col("era").isNotNull(), F.struct("era", "era_year"))
    event = F.struct("place", "work", "book", "juan", "title", "anchor", "at", "text", "snippet")
    return events.groupBy("year_ad").agg(F.count(F.lit(1)).alias("n_events"), F.array_sort(F.collect_set(label)).alias("labels"), F.array_sort(F.collect_list(event)).alias("events"))


def mentions(annotations: DataFrame, segments: DataFrame, chapters: DataFrame, roster: DataFrame) -> DataFrame:
    """One row per person, chapter and segment outside the person's own chapters: first place, longest surface, snippet."""
    own = roster.select(F.col("id").alias("person_id"), F.explode("bio_chapters").alias("chapter"))
    seen = annotations.where("type = 'person'").join(own, ["person_id", "chapter"], "left_anti")
    first = seen.groupBy("person_id", "chapter", "anchor").agg(F.min("at").alias("at"), F.max_by("text", F.struct(F.length("text"), -F.col("at"))).alias("text"), F.min_by("via", "at").alias("via"), F.count(F.lit(1)).alias("n_spans"))
    full = first.join(segments.select(F.col("seg_id").alias("anchor"), F.col("text").alias("whole")), "anchor", "left").join(chapters.select(F.col("doc").alias("chapter"), "work", "book", "juan", "title"), "chapter")
    order = Window.partitionBy("person_id").orderBy(work_rank(F.col("work")), "chapter", "anchor", "at")
    return full.withColumn("snippet", snippet(F.coalesce("whole", F.lit("")), F.col("at"))).withColumn("place", F.row_number().over(order)).drop("whole")


def people_index(roster: DataFrame, found: DataFrame) -> DataFrame:
    """The roster with the number of mentions in all and by work, most mentioned first."""
    by_work = found.groupBy("person_id", "work").agg(F.count(F.lit(1)).alias("n"))
    counts = by_work.groupBy("person_id").agg(F.sum("n").alias("n_mentions"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("work", "n")))).alias("mentions_by_work"))
    return roster.join(counts.withColumnRenamed("person_id", "id"), "id", "left").na.fill({"n_mentions": 0}).orderBy(F.desc("n_mentions"), "id")


def name_index(roster: DataFrame) -> DataFrame:
    """(name, id): every name once, for the first person of the roster that has it; longest names first."""
    name = lambda order, c: roster.select("rank", F.lit(order).alias("order"), c.alias("name"), "id")
    all_ = name(0, F.col("primary_name")).unionByName(name(1, F.explode("aliases"))).where("length(name) > 0")
    first = Window.partitionBy("name").orderBy("rank", "order")
    return all_.withColumn("n", F.row_number().over(first)).where("n = 1").orderBy(F.desc(F.length("name")), "rank", "order").select("name", "id")


def chapter_docs(segments: DataFrame, annotations: DataFrame) -> DataFrame:
    """Per chapter its segments in order, each with its annotations in order (an empty list where there are none)."""
    one = F.struct("at", "id", "type", "length", "text", "kind", "resolution", "year_ad", "era", "era_year", "month_chinese", "month_ordinal", "reasoning", "confidence", "person_id", "via")
    per = annotations.groupBy(F.col("anchor").alias("seg_id")).agg(F.array_sort(F.collect_list(one)).alias("annotations"))
    rows = segments.join(per, "seg_id", "left").withColumn("annotations", F.coalesce("annotations", F.array()))
    return rows.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("seg_idx", "seg_id", "text", "annotations"))).alias("segments"))


def chapter_counts(segments: DataFrame, annotations: DataFrame) -> DataFrame:
    n = segments.groupBy("doc").agg(F.count(F.lit(1)).alias("n_segments"))
    kinds = annotations.groupBy(F.col("chapter").alias("doc")).agg(F.count_if(F.col("type").isin("pei", "lixian")).alias("n_pei"), F.count_if(F.col("type") == "temporal").alias("n_temporal"), F.count_if(F.col("type") == "person").alias("n_persons"))
    return n.join(kinds, "doc", "left").na.fill(0)


def book_index(chapters: DataFrame, counts: DataFrame) -> DataFrame:
    """Per work and book its chapters in order of juan, with counts."""
    return chapters.join(counts, "doc", "left").groupBy("work", "book").agg(F.array_sort(F.collect_list(F.struct("juan", "doc", "title", "n_segments", "n_pei", "n_temporal", "n_persons"))).alias("chapters"))


def tooltip(*parts: Column) -> Column:
    return F.concat_ws(" · ", *(F.nullif(p, F.lit("")) for p in parts))


def date_range(birth: Column, death: Column) -> Column:
    known = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    return F.when(birth.isNull() & death.isNull(), "").otherwise(F.concat(known(birth), F.lit("-"), known(death)))


def year_label(year: Column) -> Column:
    return F.when(year < 0, F.concat(-year, F.lit(" BCE"))).otherwise(F.concat(F.lit("AD "), year))


#: Lower ends of the bands of mentions.
BANDS = [100, 50, 20, 10, 5, 1, 0]


def band(n: Column, edges: list[int] = BANDS) -> Column:
    """The band of a count, as `lowest+` or `lowest-highest`; null below all."""
    out = F.lit(None).cast("string")
    for low, above in sorted(zip(edges, [None, *edges], strict=False), reverse=False):
        label = f"{low}+" if above is None else str(low) if above == low + 1 else f"{low}-{above - 1}"
        out = F.when(n >= low, label).otherwise(out)
    return out


def in_bands(counted: DataFrame, n: str, edges: list[int] = BANDS) -> DataFrame:
    """(band, lowest, n_rows) of the bands that have rows, highest first."""
    low = F.greatest(*(F.when(F.col(n) >= e, e) for e in edges)) if len(edges) > 1 else F.when(F.col(n) >= edges[0], edges[0])
    return counted.groupBy(band(F.col(n), edges).alias("band"), low.alias("lowest")).agg(F.count(F.lit(1)).alias("n_rows")).where("band IS NOT NULL").orderBy(F.desc("lowest"))


def groups_in_order(rows: DataFrame, key: str, place: str) -> DataFrame:
    """(key, first_place, n): the groups in the order in which they first appear."""
    return rows.groupBy(key).agg(F.min(place).alias("first_place"), F.count(F.lit(1)).alias("n")).orderBy("first_place")


def numbered(rows: DataFrame, group: str, order: list[str], kind: str = "type") -> DataFrame:
    """rows with `number`, counted from 1 within each group and kind, as shown beside a text."""
    return rows.withColumn("number", F.row_number().over(Window.partitionBy(group, kind).orderBy(*order)))


def escaped(text: Column) -> Column:
    """Text as HTML."""
    for raw, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(raw), F.lit(name))
    return text


def toc_label(seg_id: Column) -> Column:
    """A segment's number in its chapter: the id's tail without the p."""
    return F.regexp_replace(F.substring_index(seg_id, ".", -1), "^p", "")


def chapter_route(doc: Column) -> Column:
    """The address of a chapter's view: `#/chapter/book/juan`."""
    return F.concat(F.lit("#/chapter/"), F.replace(doc, F.lit("."), F.lit("/")))


def linked(text: Column, spans: Column) -> Column:
    """The text with `[surface](id)` for each of the spans (at, length, id), which are in order and do not overlap."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(s: Column, p: Column) -> Column:
        before = F.substring(text, s["at"] + 1, p["at"] - s["at"])
        return F.struct(F.concat(s["out"], before, F.lit("["), F.substring(text, p["at"] + 1, p["length"]), F.lit("]("), p["id"], F.lit(")")).alias("out"), (p["at"] + p["length"]).cast("int").alias("at"))

    return F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def site_annotation() -> Column:
    """An annotation as JSON with the fields of its type only, defaults filled in and empty fields left out."""
    c, temporal, person = F.col, F.col("type") == "temporal", F.col("type") == "person"
    of = lambda cond, value: F.when(cond, value)
    fields = {
        "id": c("id"), "type": c("type"), "at": c("at"), "length": F.coalesce("length", F.lit(0)), "text": F.coalesce("text", F.lit("")),
        "kind": of(temporal, F.coalesce("kind", F.lit("absolute"))), "resolution": of(temporal, F.coalesce("resolution", F.lit("absolute"))),
        **{k: of(temporal, c(k)) for k in ("year_ad", "era", "era_year", "month_chinese", "month_ordinal", "confidence")},
        "person_id": of(person, c("person_id")), "via": of(person, F.coalesce("via", F.lit("primary"))),
        "reasoning": of(temporal | person, F.nullif("reasoning", F.lit(""))),
    }
    return F.to_json(F.struct(*(v.alias(k) for k, v in fields.items())), {"ignoreNullFields": "true"})


def rendered(text: Column, events: Column) -> Column:
    """A segment's text with marks at its annotations.

    events: structs of at, rank and mark; marks at one place stand in order of rank (opening dates, opening people, notes,
    closing people, closing dates), and the text around them is kept as it is.
    """
    ordered = F.array_sort(events, lambda a, b: F.when(a["at"] != b["at"], a["at"] - b["at"]).otherwise(a["rank"] - b["rank"]).cast("int"))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda s, e: F.struct(F.concat(s["out"], F.substring(text, s["at"] + 1, e["at"] - s["at"]), e["mark"]).alias("out"), e["at"].cast("int").alias("at"))
    return F.aggregate(ordered, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def mark_events(dates: DataFrame, people: DataFrame, notes: DataFrame) -> DataFrame:
    """(seg_id, events) for rendered(); people that overlap a date of their segment are left out."""
    from .spans import overlap_anti

    ends = lambda df: df.withColumn("end", F.col("at") + F.col("length"))
    dates, people = ends(dates), overlap_anti(ends(people), ends(dates), "seg_id")
    event = lambda df, at, rank, mark: df.select("seg_id", F.struct(F.col(at).cast("int").alias("at"), F.lit(rank).alias("rank"), mark.alias("mark")).alias("event"))
    all_ = event(dates, "at", 0, F.lit("{")).unionByName(event(people, "at", 1, F.lit("["))).unionByName(event(notes, "at", 3, F.lit("*")))
    # a span of no length closes where it opens, behind its own opening mark
    all_ = all_.unionByName(event(people, "end", 4, F.concat(F.lit("]("), "person_id", F.lit(")")))).unionByName(event(dates, "end", 5, F.concat(F.lit("}("), F.col("year_ad").cast("string"), F.lit(")"))))
    return all_.groupBy("seg_id").agg(F.collect_list("event").alias("events"))
