"""Writers: the canonical sink is Parquet, exports are text, JSON and YAML-like snippets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import natural_key, type_rank


def markdown(segments: DataFrame, front: DataFrame) -> DataFrame:
    """(path, content): files with front matter and anchored paragraphs. front has path and `head`, the block between the rules."""
    one = F.struct("seg_idx", F.concat(F.lit('<a id="'), F.col("seg_id"), F.lit('"></a>\n'), F.col("text"), F.lit("\n")).alias("block"))
    bodies = segments.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda s: s["block"]), "\n").alias("body"))
    return front.join(bodies, "path").select("path", F.concat(F.lit("---\n"), F.col("head"), F.lit("---\n"), F.col("body")).alias("content"))


def write_layer(annotations: DataFrame, path: str) -> None:
    """Annotations as Parquet, a folder per type; types that are written replace their folder only."""
    annotations.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("type").parquet(path)


def _yaml(values: list[str], build, columns: list[str], rows: DataFrame) -> DataFrame:
    def run(batches):
        import pyarrow as pa
        import yaml

        dumper = getattr(yaml, "CSafeDumper", yaml.SafeDumper)
        for batch in batches:
            out = [yaml.dump(build(r), Dumper=dumper, allow_unicode=True, sort_keys=False, width=120) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in columns), pa.array(out, pa.string())], names=[*columns, "content"])

    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
    return rows.select(*values).mapInArrow(run, f"{types}, content string")


def annotation_yaml(annotations: DataFrame, sources: DataFrame) -> DataFrame:
    """(chapter, content): a file per chapter, empty fields left out. sources: chapter, source_id, source_url, retrieved, source_sha256, warnings (an array)."""
    fields = ["id", "anchor", "at", "length", "type", "text", "kind", "resolution", "year_ad", "era", "era_year", "month_chinese", "month_ordinal", "reasoning", "confidence", "person_id", "via"]
    rank = type_rank(F.col("type")).alias("rank")
    per = annotations.groupBy("chapter").agg(F.array_sort(F.collect_list(F.struct(natural_key(F.col("anchor")).alias("key"), F.col("at").alias("place"), rank, F.col("id").alias("own"), F.struct(*fields).alias("a")))).alias("all"))
    rows = sources.join(per.select("chapter", F.transform("all", lambda x: x["a"]).alias("annotations")), "chapter", "left")

    def build(r: dict) -> dict:
        doc = {"chapter": r["chapter"], "source": {"id": r["source_id"], "url": r["source_url"], "retrieved": r["retrieved"], "sha256": r["source_sha256"]}}
        if r["warnings"]:
            doc["parse_warnings"] = list(r["warnings"])
        doc["annotations"] = [{k: v for k, v in a.items() if v is not None} for a in r["annotations"] or []]
        return doc

    return _yaml(["chapter", "source_id", "source_url", "retrieved", "source_sha256", "warnings", "annotations"], build, ["chapter"], rows)


#: Fixed values of the variants format: the text that others are compared with, and the method's name.
COMPARED_WITH, METHOD = "wikisource", "normalized_hash_diff"


def variant_yaml(alignments: DataFrame, diffs: DataFrame) -> DataFrame:
    """(chapter, content): a file per chapter that compares a source with the text.

    alignments: chapter, source_id, url, retrieved, file_sha256, n_paragraphs, n_segments, n_aligned, unaligned (ids), unaligned_source
    (numbers from 1). diffs: chapter, seg_id, canonical_hash, normalized_hash, source_para_no, kind, equal_normalized, ops (an edit script or null).
    """
    one = F.struct(natural_key(F.col("seg_id")).alias("key"), F.struct("seg_id", "canonical_hash", "normalized_hash", "source_para_no", "kind", "equal_normalized", "ops").alias("d"))
    per = diffs.groupBy("chapter").agg(F.transform(F.array_sort(F.collect_list(one), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)), lambda x: x["d"]).alias("diffs"))

    def build(r: dict) -> dict:
        segments = {}
        for d in r["diffs"] or []:
            entry = {"source": r["source_id"], "source_para_no": d["source_para_no"], "kind": d["kind"], "equal_normalized": d["equal_normalized"]}
            if d["ops"]:
                entry["ops"] = [{k: v for k, v in op.items() if v is not None} for op in d["ops"]]
            segments[d["seg_id"]] = {"canonical_hash": d["canonical_hash"], "canonical_normalized_hash": d["normalized_hash"], "diffs": [entry]}
        return {
            "chapter": r["chapter"], "canonical": COMPARED_WITH,
            "sources": {r["source_id"]: {"url": r["url"], "retrieved": r["retrieved"], "file_sha256": r["file_sha256"], "n_paragraphs": r["n_paragraphs"]}},
            "alignment": {"method": METHOD, "n_canonical_segments": r["n_segments"], "n_aligned": r["n_aligned"], "unaligned_canonical": list(r["unaligned"] or []), "unaligned_source": {r["source_id"]: list(r["unaligned_source"] or [])}},
            "segments": segments,
        }

    rows = alignments.join(per, "chapter", "left")
    return _yaml([*alignments.columns, "diffs"], build, ["chapter"], rows)


def stamped(contents: DataFrame, hashes: DataFrame) -> DataFrame:
    """(path, content, state): files whose front matter holds the present hash of their segments; state is OK or MISMATCH as they were. hashes: path, segments_sha256."""
    line = "(?m)^segments_sha256:[ \\t]*['\"]?([0-9a-f]*)['\"]?[ \\t]*$"
    head, rest = F.regexp_extract("content", "(?s)^(---\\n.*?\\n---\\n)", 1), F.regexp_replace("content", "(?s)^---\\n.*?\\n---\\n", "")
    now = F.col("segments_sha256")
    new = F.when(head.rlike(line), F.regexp_replace(head, F.lit(line), F.concat(F.lit("segments_sha256: "), now))).otherwise(F.concat(F.substring(head, F.lit(1), F.length(head) - 4), F.lit("segments_sha256: "), now, F.lit("\n---\n")))
    state = F.when(F.regexp_extract(head, line, 1) == now, "OK").otherwise("MISMATCH")
    return contents.join(hashes, "path").select("path", F.concat(new, rest).alias("content"), state.alias("state"))


def write_files(rows: DataFrame, path: str, name: str = "path") -> None:
    """Texts by name, a folder for each; their last line end is the writer's."""
    rows.select(name, F.regexp_replace("content", "\\n\\z", "").alias("content")).write.mode("overwrite").partitionBy(name).text(path)


def write_json(rows: DataFrame, path: str, by: str | None = None) -> None:
    out = rows.write.mode("overwrite").option("ignoreNullFields", True)
    (out.partitionBy(by) if by else out).json(path)


def free_ids(candidates: DataFrame, wanted: str, taken: DataFrame, order: list[str]) -> DataFrame:
    """candidates with `id`: the wanted one, or with _2, _3, ... where it is taken or wanted again. taken has id."""
    stem = F.regexp_replace("id", "_\\d+$", "")
    used = taken.groupBy(stem.alias(wanted)).agg(F.max(F.coalesce(F.regexp_extract("id", "_(\\d+)$", 1).try_cast("int"), F.lit(1))).alias("_used"))
    n = F.row_number().over(Window.partitionBy(wanted).orderBy(*order)) + F.coalesce(F.col("_used"), F.lit(0))
    numbered = candidates.join(used, wanted, "left").withColumn("_n", n)
    return numbered.withColumn("id", F.when(F.col("_n") == 1, F.col(wanted)).otherwise(F.concat(F.col(wanted), F.lit("_"), F.col("_n")))).drop("_n", "_used")


#: Folders, widths of chapter numbers and endings of a corpus's files.
PATHS = {"text": ("texts", "md"), "annotation": ("annotations", "yaml"), "variant": ("variants", "yaml"), "source": ("sources", "html"), "data": ("site/data/chapters", "json")}


def path_of(kind: str, work: Column, book: Column, juan: Column, width: int = 2) -> Column:
    """A chapter's file of a kind in PATHS."""
    folder, suffix = PATHS[kind]
    return F.concat(F.lit(f"{folder}/"), chapter_path(work, book, juan, width, suffix))


def chapter_path(work: Column, book: Column, juan: Column, width: int = 2, suffix: str = "md") -> Column:
    return F.concat_ws("/", work, book, F.concat(F.lpad(juan.cast("string"), width, "0"), F.lit(f".{suffix}")))
