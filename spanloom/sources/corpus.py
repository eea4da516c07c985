"""Readers of a corpus in Markdown, YAML and JSON files."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FRONT = "path string, work string, work_title string, book string, book_title string, juan int, title string, author string, script string, source_id string, source_url string, retrieved string, source_sha256 string, segments_sha256 string, error string"
ANNOTATION = """chapter string, id string, anchor string, at int, length int, type string, text string, kind string, resolution string,
    year_ad int, era string, era_year int, month_chinese string, month_ordinal int, reasoning string, confidence double, person_id string, via string"""
ROSTER = """id string, primary_name string, courtesy_name string, given_name string, given_name_blockers array<string>, aliases array<string>,
    chapter_aliases map<string,array<string>>, other_names array<string>, birth_ad int, death_ad int, brief string, bio_chapters array<string>"""


def files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Whole files below a folder as (path, content)."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def segments(contents: DataFrame) -> DataFrame:
    """Anchored paragraphs of Markdown files: path, doc, book, juan, seg_idx, seg_id, para_no, suffix, text."""
    body = F.regexp_replace("content", "(?s)^---\\n.*?\\n---\\n", "")
    pair = "<a id=\"([^\"]+)\"></a>[ \\t]*\\n([^\\n]*(?:\\n(?!\\n|<a id)[^\\n]*)*)"
    found = contents.select("path", F.posexplode(F.regexp_extract_all(body, F.lit(pair), 0)).alias("seg_idx", "raw"))
    seg_id = F.regexp_extract("raw", pair, 1)
    return found.select(
        "path",
        F.regexp_extract(seg_id, "^(.*)\\.p\\d+[a-z]*$", 1).alias("doc"),
        F.regexp_extract(seg_id, "^([^.]+)\\.", 1).alias("book"),
        F.regexp_extract(seg_id, "^[^.]+\\.(\\d+)\\.", 1).try_cast("int").alias("juan"),
        "seg_idx",
        seg_id.alias("seg_id"),
        F.regexp_extract(seg_id, "\\.p(\\d+)[a-z]*$", 1).try_cast("int").alias("para_no"),
        F.regexp_extract(seg_id, "\\.p\\d+([a-z]*)$", 1).alias("suffix"),
        F.btrim(F.regexp_extract("raw", pair, 2), F.lit(" \t\r\n")).alias("text"),
    )


def format_errors(contents: DataFrame) -> DataFrame:
    """(path, message) for files without front matter or segments, with loose text, or with repeated segment ids."""
    front = F.col("content").rlike("(?s)^---\\n.*?\\n---(\\n|$)")
    body = F.regexp_replace("content", "(?s)^---\\n.*?\\n---\\n", "")
    ids = F.regexp_extract_all(body, F.lit("<a id=\"([^\"]+)\"></a>"), 1)
    loose = F.btrim(F.regexp_extract(body, "(?s)^(.*?)(?:<a id=|$)", 1), F.lit(" \t\r\n")) != ""
    rules = [(~front, "front matter is missing"), (front & (F.size(ids) == 0), "no segments"), (front & (F.size(ids) > 0) & loose, "text before the first segment"), (F.size(ids) > F.size(F.array_distinct(ids)), "a segment id is repeated")]
    messages = F.array(*(F.when(c, F.lit(m)) for c, m in rules))
    return contents.select("path", F.explode(F.filter(messages, lambda m: m.isNotNull())).alias("message"))


def _yaml_rows(pick, columns: list[str]):
    def run(batches):
        import yaml

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
        for batch in batches:
            rows = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows += pick(path, content, lambda s: yaml.load(s, loader))
            yield rows, columns

    return run


def _typed(schema: str, spark: SparkSession) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def _read(contents: DataFrame, pick, schema: str) -> DataFrame:
    arrow = _typed(schema, contents.sparkSession)
    rows = _yaml_rows(pick, arrow.names)

    def run(batches):
        for got, _ in rows(batches):
            yield from pa.Table.from_pylist(got, schema=arrow).to_batches()

    return contents.select("path", "content").mapInArrow(run, schema)


def front_matter(contents: DataFrame) -> DataFrame:
    """One row per file; `error` says what could not be read."""

    def pick(path, content, load):
        try:
            head = load(content.split("\n---\n", 1)[0].removeprefix("---\n")) or {}
            source = head.get("source") or {}
            text = lambda v: None if v is None else str(v)
            juan = head.get("juan")
            return [{"path": path, **{k: text(head.get(k)) for k in ("work", "work_title", "book", "book_title", "title", "author", "script", "segments_sha256")}, "juan": juan if isinstance(juan, int) else None, "source_id": text(source.get("id")), "source_url": text(source.get("url")), "retrieved": text(source.get("retrieved")), "source_sha256": text(source.get("sha256")), "error": None}]
        except Exception as e:  # noqa: BLE001  a file that cannot be read is a row, not the end of the job
            return [{"path": path, "error": f"{type(e).__name__}: {e}"[:500]}]

    return _read(contents, pick, FRONT)


def annotations(contents: DataFrame) -> DataFrame:
    """Rows of annotation files. Files that cannot be read give none; annotation_file_errors() names them."""
    names = [c.split()[0] for c in ANNOTATION.replace("\n", " ").split(",")]

    def pick(path, content, load):
        try:
            doc = load(content)
        except Exception:  # noqa: BLE001  a file that cannot be read is an error row, not the end of the job
            return []
        if not isinstance(doc, dict) or not isinstance(doc.get("annotations"), list):
            return []
        return [{"chapter": doc.get("chapter"), **{k: a.get(k) for k in names if k != "chapter"}} for a in doc["annotations"] if isinstance(a, dict)]

    return _read(contents, pick, ANNOTATION.replace("\n", " "))


def annotation_file_errors(contents: DataFrame, sources: list[str]) -> DataFrame:
    """(path, message) for annotation files that cannot be read or whose head breaks a rule."""

    def pick(path, content, load):
        try:
            doc = load(content)
        except Exception as e:  # noqa: BLE001
            return [{"path": path, "message": f"the file cannot be read: {type(e).__name__}"}]
        if not isinstance(doc, dict):
            return [{"path": path, "message": "the file is not a mapping"}]
        found = [f"{k} is missing" for k in ("chapter", "source", "annotations") if k not in doc]
        if not found:
            head = doc["source"]
            if not re.fullmatch(r"[a-z]+\.\d+", str(doc["chapter"])):
                found.append("the chapter does not fit")
            if not isinstance(head, dict):
                found.append("the source is not a mapping")
            else:
                found += [f"source.{k} is missing" for k in ("id", "url", "retrieved", "sha256") if k not in head]
                if head.get("id") and head["id"] not in sources:
                    found.append("the source is unknown")
                if head.get("sha256") and not re.fullmatch("[0-9a-f]{64}", str(head["sha256"])):
                    found.append("the hash does not fit")
            if not isinstance(doc["annotations"], list):
                found.append("the annotations are not a list")
            else:
                found += [f"annotation {n} is not a mapping" for n, a in enumerate(doc["annotations"]) if not isinstance(a, dict)]
        return [{"path": path, "message": m} for m in found]

    return _read(contents, pick, "path string, message string")


def json_rows(spark: SparkSession, path: str, schema: str, pattern: str = "*.json") -> DataFrame:
    """One row per JSON document below a folder; what cannot be read is a row with `error`."""
    raw = spark.read.schema(f"{schema}, error string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "error")
    return raw.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).json(path)


def path_kind(path: Column) -> Column:
    """What a file of a corpus is: text, annotation, variant or skip."""
    low, yaml_file = F.lower(path), F.lower(path).rlike("\\.ya?ml$")
    below = lambda folder: path.rlike(f"(^|/){folder}/")
    return F.when(low.endswith(".md"), "text").when(yaml_file & below("annotations"), "annotation").when(yaml_file & below("variants"), "variant").otherwise("skip")


def roster(spark: SparkSession, path: str) -> DataFrame:
    """A people file with `rank` in the file's order. Repeated ids and missing keys are errors."""
    import yaml

    content = files(spark, *path.rsplit("/", 1)).first()["content"]
    people = yaml.safe_load(content)
    people = people.get("people", people) if isinstance(people, dict) else people
    seen: set[str] = set()
    rows = []
    for n, p in enumerate(people):
        missing = [k for k in ("id", "primary_name") if not p.get(k)]
        if missing or p["id"] in seen:
            raise ValueError(f"person {n}: " + (f"missing {', '.join(missing)}" if missing else f"id {p['id']} is repeated"))
        seen.add(p["id"])
        rows.append((n, p["id"], p["primary_name"], p.get("courtesy_name"), p.get("given_name"), p.get("given_name_blockers") or [], p.get("aliases") or [], p.get("chapter_aliases") or {}, p.get("other_names") or [], p.get("birth_ad"), p.get("death_ad"), p.get("brief"), p.get("bio_chapters") or []))
    return spark.createDataFrame(rows, "rank int, " + ROSTER.replace("\n", " "))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A chapter manifest: ctext_juan, book, juan, category, title, parts, and `pos`, the place in the file."""
    import yaml

    doc = yaml.safe_load(files(spark, *path.rsplit("/", 1)).first()["content"])
    rows = [(n, c.get("ctext_juan"), c.get("book"), c.get("juan"), c.get("category"), c.get("title"), c.get("parts") or []) for n, c in enumerate(doc["chapters"])]
    return spark.createDataFrame(rows, "pos int, ctext_juan int, book string, juan int, category string, title string, parts array<string>")


def not_landed(wanted: DataFrame, landed: DataFrame, key: list[str]) -> DataFrame:
    """Manifest rows whose snapshots are missing."""
    return wanted.join(landed, key, "left_anti")


def to_read(wanted: DataFrame, landed: DataFrame, key: list[str], mode: str = "auto", only: list | None = None, resume: DataFrame | None = None) -> DataFrame:
    """Manifest rows with what to do about each: `cache`, `fetch` or `missing`.

    auto reads what has landed and fetches the rest; refetch fetches all; no-fetch fetches nothing, so what has not landed is missing. only keeps
    rows whose first key is listed, resume leaves out those that it has.
    """
    if mode not in ("auto", "no-fetch", "refetch"):
        raise ValueError(f"mode {mode}")
    rows = wanted if only is None else wanted.where(F.col(key[0]).isin(only))
    rows = rows if resume is None else rows.join(resume.select(*key).distinct(), key, "left_anti")
    marked = rows.join(landed.select(*key).distinct().withColumn("_landed", F.lit(True)), key, "left")
    here = F.col("_landed").isNotNull()
    action = F.lit("fetch") if mode == "refetch" else F.when(here, "cache").otherwise("missing" if mode == "no-fetch" else "fetch")
    return marked.withColumn("action", action).drop("_landed")


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Landed files with the hash of their bytes."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", F.sha2("content", 256).alias("sha256"), "content")
