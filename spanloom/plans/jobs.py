"""Batch jobs over a corpus folder: Parquet tables segments, annotations (a folder per type), chapters and roster.

Each job reads tables, writes whole layers and leaves the others alone, so that running it twice changes nothing. Jobs return a
table of what they did. `only` keeps the chapters named, `resume` leaves out those that are done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import align, brackets, dates, disambiguate, merge, persons, publish, validate
from ..sources import corpus as readers
from ..sources import html, sinks

FIELDS = [c.split()[0] for c in readers.ANNOTATION.replace("\n", " ").split(",")]


def _table(spark: SparkSession, folder: str, name: str, only: list[str] | None = None, key: str = "doc") -> DataFrame:
    rows = spark.read.parquet(f"{folder}/{name}")
    return rows if only is None else rows.where(F.col(key).isin(only))


def _layer(rows: DataFrame, tag: str) -> DataFrame:
    """rows as annotations with ids, all fields there."""
    numbered = merge.with_ids(rows, "anchor", tag, ["at", "length"])
    types = {f.split()[0]: f.split()[1] for f in readers.ANNOTATION.replace("\n", " ").split(",")}
    return numbered.select(*((F.col(c) if c in numbered.columns else F.lit(None)).cast(types[c]).alias(c) for c in FIELDS))


def _write(rows: DataFrame, folder: str, kind: str, only: list[str] | None) -> DataFrame:
    """Replace one type's rows of the chapters named, or of all; the other chapters' rows of that type stay."""
    spark, path = rows.sparkSession, f"{folder}/annotations"
    if only is not None:
        rest = spark.read.parquet(path).where((F.col("type") == kind) & ~F.col("chapter").isin(only)).select(*FIELDS)
        rest.unionByName(rows).write.mode("overwrite").parquet(f"{folder}/_merged")  # read before their folder is replaced
        rows = spark.read.parquet(f"{folder}/_merged")
    sinks.write_layer(rows, path)
    return spark.read.parquet(path).where(F.col("type") == kind).groupBy("chapter").agg(F.count(F.lit(1)).alias("n"))


def ingest(spark: SparkSession, snapshots: str, manifest: DataFrame, folder: str, only: list[str] | None = None) -> DataFrame:
    """Wiki pages below a folder as segments and commentary. manifest: doc, work, book, juan, title, file. Returns doc and status: ok, missing or empty."""
    files = readers.files(spark, snapshots, "*.html").withColumn("file", F.element_at(F.split("path", "/"), -1)).drop("path")
    wanted = manifest if only is None else manifest.where(F.col("doc").isin(only))
    pages = wanted.join(files, "file", "left")
    found = html.paragraphs(pages.where("content IS NOT NULL"), "doc", html.wiki_body(F.col("content")))
    split = brackets.split_notes(found, "doc", "para_no")
    own = wanted.select("doc", "book", "juan")
    segments = split.join(own, "doc").select(
        "doc", (F.col("para_no") - 1).alias("seg_idx"), F.concat("doc", F.lit(".p"), F.col("para_no").cast("string")).alias("seg_id"), "book", "juan", F.col("main_text").alias("text"), "notes"
    )
    segments.drop("notes").write.mode("overwrite").parquet(f"{folder}/segments")
    wanted.select("doc", "work", "book", "juan", "title").write.mode("overwrite").parquet(f"{folder}/chapters")
    notes = segments.select(F.col("doc").alias("chapter"), F.col("seg_id").alias("anchor"), F.inline("notes")).select("chapter", "anchor", "at", F.lit(0).alias("length"), F.lit("pei").alias("type"), "text")
    sinks.write_layer(_layer(notes, "a"), f"{folder}/annotations")
    n = spark.read.parquet(f"{folder}/segments").groupBy("doc").agg(F.count(F.lit(1)).alias("n_segments"))
    status = F.when(F.col("content").isNull(), "missing").when(F.col("n_segments").isNull(), "empty").otherwise("ok")
    return pages.join(n, "doc", "left").select("doc", status.alias("status"), F.coalesce("n_segments", F.lit(0)).alias("n_segments"))


def extract_dates(spark: SparkSession, folder: str, only: list[str] | None = None) -> DataFrame:
    found = dates.resolve(dates.mentions(_table(spark, folder, "segments", only), dates.eras(spark), dates.book_dynasties(spark)))
    rows = found.select(F.col("doc").alias("chapter"), F.col("seg_id").alias("anchor"), "at", "length", F.lit("temporal").alias("type"), F.col("surface").alias("text"), *FIELDS[FIELDS.index("kind") : FIELDS.index("person_id")])
    return _write(_layer(rows, "t"), folder, "temporal", only)


def extract_persons(spark: SparkSession, folder: str, only: list[str] | None = None) -> DataFrame:
    found = persons.person_spans(_table(spark, folder, "segments", only), _table(spark, folder, "roster"))
    rows = found.select(F.col("doc").alias("chapter"), F.col("seg_id").alias("anchor"), "at", "length", F.lit("person").alias("type"), F.col("surface").alias("text"), "person_id", "via")
    return _write(_layer(rows, "h"), folder, "person", only)


def extract_bio_subjects(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """People who are introduced and not in the roster, most mentioned first, with ids that are free."""
    known = _table(spark, folder, "roster")
    names = known.select(F.col("primary_name").alias("name")).unionByName(known.select(F.explode("aliases").alias("name"))).distinct()
    found = persons.introductions(_table(spark, folder, "segments"), names)
    stems = found.withColumn("stem", text.latin_id(F.col("name"), text.romanization(spark)))
    named = sinks.free_ids(stems, "stem", known.select("id"), ["name", "courtesy"]).orderBy(F.desc("n_occurrences"), "id")
    return named if limit is None else named.limit(limit)


def find_ambiguous(spark: SparkSession, folder: str, out: str, only: list[str] | None = None) -> DataFrame:
    """A request for each chapter with unresolved titles, as JSON lines."""
    segments = _table(spark, folder, "segments", only)
    spans = _table(spark, folder, "annotations").where("type = 'person'").join(segments.select("doc", "seg_idx", F.col("seg_id").alias("anchor")), "anchor")
    asked = disambiguate.requests(persons.unresolved_titles(segments, spans), segments, _table(spark, folder, "roster"))
    asked.write.mode("overwrite").json(out)
    return asked.select("doc")


DECISION = "anchor string, at int, length int, surface string, person_id string, confidence double, reasoning string"


def merge_decisions(spark: SparkSession, folder: str, decisions: str) -> DataFrame:
    """Decisions in JSON files: missing people filled in from the reasoning, checked, and the accepted ones appended. Returns status, reason and n."""
    roster, old = _table(spark, folder, "roster"), _table(spark, folder, "annotations")
    given = readers.json_rows(spark, decisions, DECISION).where("error IS NULL").drop("error").withColumn("id", F.concat_ws("@", "anchor", "at"))
    filled = disambiguate.filled_from_reasoning(given, roster, disambiguate.ROLE_WORDS).drop("id")
    people = old.where("type = 'person'").select(*FIELDS)
    checked = disambiguate.checked(filled, _table(spark, folder, "segments"), roster, people.select("anchor", "at")).persist()
    counts = spark.createDataFrame(checked.groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n")).collect(), "status string, reason string, n long")
    new = disambiguate.merged(people, checked).select(*FIELDS)
    new.write.mode("overwrite").parquet(f"{folder}/_merged")
    checked.unpersist()
    sinks.write_layer(spark.read.parquet(f"{folder}/_merged"), f"{folder}/annotations")
    return counts


def build_variants(spark: SparkSession, folder: str, other: DataFrame, mapping: tuple[str, str] = ("", "")) -> DataFrame:
    """(chapter, seg_id, canonical_hash, normalized_hash, source_para_no, kind, equal_normalized, ops) of segments that differ in another source (doc, para_no, text)."""
    place = lambda order: F.row_number().over(Window.partitionBy("doc").orderBy(order)) - 1
    own = _table(spark, folder, "segments").select(F.col("doc").alias("chapter"), "seg_id", place("seg_idx").alias("left_no"), F.col("text").alias("old"))
    source = other.select(F.col("doc").alias("chapter"), "para_no", place("para_no").alias("right_no"), F.col("text").alias("new"))
    side = lambda df, n, t: df.select("chapter", F.col(n).alias("n"), F.col(t).alias("text"))
    pairs = align.align(side(own, "left_no", "old"), side(source, "right_no", "new"), "chapter", "n")
    both = pairs.join(own, ["chapter", "left_no"]).join(source, ["chapter", "right_no"])
    kind = align.classify(F.col("old"), F.col("new"), mapping)
    rows = align.edit_scripts(both.withColumn("kind", kind).where("kind <> 'equal'"), "old", "new")
    return rows.select("chapter", "seg_id", text.canonical_hash(F.col("old")).alias("canonical_hash"), text.normalized_hash(F.col("old"), mapping).alias("normalized_hash"), F.col("para_no").alias("source_para_no"), "kind", (F.col("kind") == "variant_char").alias("equal_normalized"), "ops")


def publish_site(spark: SparkSession, folder: str, out: str) -> DataFrame:
    """Chapters, timeline and people as JSON with their indexes. Returns name and rows of what was written."""
    segments, notes, chapters, roster = (_table(spark, folder, t) for t in ("segments", "annotations", "chapters", "roster"))
    notes = notes.select(*FIELDS)
    found = publish.mentions(notes, segments, chapters, roster)
    by_person = found.groupBy(F.col("person_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("place", "work", "chapter", "anchor", "at", "text", "via", "snippet"))).alias("mentions"))
    views = {
        "chapters": publish.chapter_docs(segments, notes),
        "chapter_index": publish.book_index(chapters, publish.chapter_counts(segments, notes)),
        "timeline": publish.timeline_years(publish.timeline_events(notes, segments, chapters)),
        "people": roster.join(by_person, "id", "left"),
        "people_index": publish.people_index(roster, found),
        "names": publish.name_index(roster),
    }
    for name, rows in views.items():
        sinks.write_json(rows, f"{out}/{name}")
    return spark.createDataFrame([(name, spark.read.json(f"{out}/{name}").count()) for name in views], "name string, n long")


def check(spark: SparkSession, root: str, strict_ends: bool = False) -> DataFrame:
    """(path, entity_id, rule) of all text and annotation files below a folder."""
    texts = readers.files(spark, root, "*.md")
    segments = readers.segments(texts)
    heads = readers.front_matter(texts)
    owner = segments.select(F.col("seg_id").alias("entity_id"), F.col("path").alias("own")).dropDuplicates(["entity_id"])
    of_texts = validate.text_violations(heads, segments).join(owner, "entity_id", "left").select(F.coalesce("own", "entity_id").alias("path"), "entity_id", "rule")
    of_format = readers.format_errors(texts).select("path", F.col("path").alias("entity_id"), F.col("message").alias("rule"))
    layers = readers.files(spark, root, "*.y*ml").where(readers.path_kind(F.col("path")) == "annotation")
    of_files = readers.annotation_file_errors(layers, validate.SOURCES).select("path", F.col("path").alias("entity_id"), F.col("message").alias("rule"))
    of_rows = validate.annotation_violations(readers.annotations(layers), segments, strict_ends)
    at = F.regexp_extract("entity_id", "^(.*)\\.p\\d+[a-z]*\\.[a-z]+\\d+$", 1)
    return of_texts.unionByName(of_format).unionByName(of_files).unionByName(of_rows.select(at.alias("path"), "entity_id", "rule"))


def segment_hashes(spark: SparkSession, root: str, update: str | None = None) -> DataFrame:
    """(path, state) of text files: whether the stamped hash is the present one; `update` writes stamped files below a folder."""
    texts = readers.files(spark, root, "*.md")
    done = sinks.stamped(texts, validate.file_hashes(readers.segments(texts)))
    if update:
        sinks.write_files(done.withColumn("path", F.element_at(F.split("path", "/"), -1)), update)
    return done.select("path", "state")


#: Commands of the command line; each takes a folder and what its parameters say.
JOBS = {f.__name__.replace("_", "-"): f for f in (extract_dates, extract_persons, extract_bio_subjects, find_ambiguous, merge_decisions, publish_site, check, segment_hashes)}
