"""Constraint checks as tables of rules: every rule is a predicate, all run in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import canonical_hash, ordered_hash

#: Fixed values of the annotation format.
TYPES = ["pei", "lixian", "chen", "editor", "crossref", "temporal", "person"]
KINDS = ["absolute", "relative"]
RESOLUTIONS = ["absolute", "bare_month", "bare_year", "this_year", "next_year", "prev_year"]
SCRIPTS = ["traditional", "simplified"]
SOURCES = ["wikisource", "ctext"]
ANNOTATION_ID = "^[a-z]+\\.\\d+\\.p\\d+[a-z]*\\.[ath]\\d+$"
TAGS = {"temporal": "t", "person": "h"}


def violations(rows: DataFrame, entity: Column, rules: list[tuple[str, Column]]) -> DataFrame:
    """(entity_id, rule) for every rule that is true of a row."""
    broken = F.filter(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules)), lambda x: x.isNotNull())
    return rows.select(entity.cast("string").alias("entity_id"), F.explode(broken).alias("rule"))


def annotation_rules() -> list[tuple[str, Column]]:
    """Rules on annotations that carry `n_same_id` and `text_length` (null where the chapter's text is missing)."""
    c, temporal = F.col, F.col("type") == "temporal"
    return [
        *((f"{k} is missing", c(k).isNull()) for k in ("id", "anchor", "at", "length", "type", "text")),
        ("the id is not its segment's", c("text_length").isNotNull() & c("id").rlike(ANNOTATION_ID) & ~F.startswith("id", F.concat("anchor", F.lit(".")))),
        ("the segment is another chapter's", ~F.startswith("anchor", F.concat("chapter", F.lit(".")))),
        ("a point has a length", c("type").isin("pei", "lixian") & (c("length") > 0)),
        ("a person has no id", (c("type") == "person") & c("person_id").isNull()),
        ("the id does not fit", ~c("id").rlike(ANNOTATION_ID)),
        ("the id is repeated", c("n_same_id") > 1),
        ("the type is unknown", ~c("type").isin(TYPES)),
        ("the segment does not exist", c("chapter_known") & c("text_length").isNull()),
        ("the place lies outside the segment", (c("at") < 0) | (c("at") > c("text_length"))),
        ("the length is negative", c("length") < 0),
        ("the year of the era is below 1", temporal & (c("era_year") < 1)),
        ("the year is below 1", temporal & ((c("year_ad") < 1) | c("year_ad").isNull())),
        ("the month is outside 1 to 12", temporal & ~c("month_ordinal").between(1, 12)),
        ("the kind is unknown", temporal & ~c("kind").isin(KINDS)),
        ("the resolution is unknown", temporal & ~c("resolution").isin(RESOLUTIONS)),
        ("an absolute date has no era", temporal & (F.coalesce(c("kind"), F.lit("absolute")) == "absolute") & c("era").isNull()),
        ("the confidence is outside 0 to 1", ~c("confidence").between(0, 1)),
    ]


def annotation_violations(annotations: DataFrame, segments: DataFrame, strict_ends: bool = False) -> DataFrame:
    """Violations of annotations against segments (doc, seg_id, text). strict_ends also checks where spans end."""
    same = annotations.groupBy("id").agg(F.count(F.lit(1)).alias("n_same_id"))
    sizes = segments.select(F.col("seg_id").alias("anchor"), F.length("text").alias("text_length"))
    chapters = segments.select(F.col("doc").alias("chapter")).distinct().withColumn("chapter_known", F.lit(True))
    full = annotations.join(same, "id", "left").join(sizes, "anchor", "left").join(chapters, "chapter", "left").withColumn("chapter_known", F.coalesce("chapter_known", F.lit(False)))
    rules = annotation_rules()
    if strict_ends:
        rules.append(("the span ends outside the segment", F.col("at") + F.col("length") > F.col("text_length")))
    return violations(full, F.col("id"), rules)


def front_rules() -> list[tuple[str, Column]]:
    c = F.col
    required = ["work", "work_title", "book", "book_title", "title", "author", "script", "source_id", "segments_sha256"]
    return [
        *((f"{k} is missing", c(k).isNull()) for k in required),
        ("juan is not a number", c("juan").isNull()),
        ("the script is unknown", ~c("script").isin(SCRIPTS)),
        ("the source is unknown", ~c("source_id").isin(SOURCES)),
        ("a hash does not fit", ~c("segments_sha256").rlike("^[0-9a-f]{64}$") | ~c("source_sha256").rlike("^[0-9a-f]{64}$")),
    ]


def file_hashes(segments: DataFrame) -> DataFrame:
    """(path, segments_sha256): the hash over the hashes of a file's segments, in lexicographic order of ids."""
    pair = F.struct(F.col("seg_id").alias("id"), canonical_hash(F.col("text")).alias("h"))
    return segments.groupBy("path").agg(ordered_hash(F.collect_list(pair)).alias("segments_sha256"))


def text_violations(front: DataFrame, segments: DataFrame) -> DataFrame:
    """Front matter, segment ids and hash drift of text files."""
    heads = violations(front.where("error IS NULL"), F.col("path"), front_rules())
    own = segments.join(front.select("path", F.col("book").alias("own_book"), F.col("juan").alias("own_juan")), "path")
    ids = violations(own, F.col("seg_id"), [("the segment id is not the chapter's", ~F.col("seg_id").rlike("^[a-z]+\\.\\d+\\.p\\d+[a-z]*$") | (F.col("book") != F.col("own_book")) | (F.col("juan") != F.col("own_juan")))])
    drift = front.join(file_hashes(segments).withColumnRenamed("segments_sha256", "now"), "path").where("now <> segments_sha256").select(F.col("path").alias("entity_id"), F.lit("the segments have changed").alias("rule"))
    failed = front.where("error IS NOT NULL").select(F.col("path").alias("entity_id"), F.lit("the file cannot be read").alias("rule"))
    return heads.unionByName(ids).unionByName(drift).unionByName(failed)


def decision_error(text: Column, known_person: Column, least: float = 0.7) -> Column:
    """The first rule that a disambiguation decision breaks, null if it holds."""
    c = F.col
    return (
        F.when(text.isNull(), "unknown segment")
        .when(c("person_id").isNull(), "no person")
        .when(~known_person, "unknown person")
        .when(c("at").isNull() | c("length").isNull() | (c("length") <= 0), "no span")
        .when((c("at") < 0) | (c("at") + c("length") > F.length(text)), "span outside the segment")
        .when(F.substring(text, c("at") + 1, c("length")) != c("surface"), "the span holds other text")
        .when(F.coalesce(c("confidence"), F.lit(0.0)) < least, "low confidence")
    )


#: Kinds of variants, those found by comparison and those given by hand.
VARIANT_KINDS = ["equal", "variant_char", "textual", "typo", "missing", "extra", "punctuation"]


def variant_violations(diffs: DataFrame, segments: DataFrame) -> DataFrame:
    """Violations of variants (chapter, seg_id, canonical_hash, kind, source_para_no) against segments (seg_id, text)."""
    full = diffs.join(segments.select("seg_id", canonical_hash(F.col("text")).alias("now")), "seg_id", "left").join(diffs.groupBy("seg_id").agg(F.count(F.lit(1)).alias("n_same")), "seg_id")
    c = F.col
    rules = [
        ("the segment does not exist", c("now").isNull()),
        ("the segment has changed", c("now") != c("canonical_hash")),
        ("the kind is unknown", c("kind").isNull() | ~c("kind").isin(VARIANT_KINDS)),
        ("an equal segment is listed", c("kind") == "equal"),
        ("the source's paragraph is below 1", c("source_para_no").isNull() | (c("source_para_no") < 1)),
        ("the segment is another chapter's", ~F.startswith("seg_id", F.concat("chapter", F.lit(".")))),
        ("the segment is repeated", c("n_same") > 1),
    ]
    return violations(full, c("seg_id"), rules)


def low_confidence(confidence: Column, least: float = 0.7) -> Column:
    return F.coalesce(confidence < least, F.lit(False))


def summary(files: DataFrame) -> DataFrame:
    """(n_files, n_failed) of by_file()."""
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("status") == "FAIL").alias("n_failed"))


def by_file(found: DataFrame, all_entities: DataFrame, key: str) -> DataFrame:
    """Per file OK or FAIL with the number of violations."""
    n = found.groupBy(F.col("entity_id").alias(key)).agg(F.count(F.lit(1)).alias("n_violations"))
    return all_entities.select(key).distinct().join(n, key, "left").select(key, F.coalesce("n_violations", F.lit(0)).alias("n_violations"), F.when(F.col("n_violations") > 0, "FAIL").otherwise("OK").alias("status"))
