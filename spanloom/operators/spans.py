"""Spans over texts: finding, dictionary matching, overlap, greedy choice and carrying over."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = "array<struct<at:int,length:int,surface:string>>"


_RUN = 64  # matches that are placed together


def _with(value: Column, use) -> Column:
    """use(value), where the value is computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _placed(gaps: Column, surfaces: Column) -> Column:
    """Spans of surfaces that follow one another, each behind its gap. In runs, so that work grows in proportion to their number."""
    empty = F.struct(F.lit(0).alias("end"), F.array().cast(SPAN).alias("out"))

    def step(s: Column, m: Column) -> Column:
        at = s["end"] + F.length(m["gap"])
        one = F.struct(at.cast("int").alias("at"), F.length(m["surface"]).cast("int").alias("length"), m["surface"].alias("surface"))
        return F.struct((at + F.length(m["surface"])).cast("int").alias("end"), F.array_append(s["out"], one).alias("out"))

    def in_runs(all_: Column) -> Column:
        n = F.size(all_)
        runs = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _RUN).cast("int")), lambda k: F.aggregate(F.slice(all_, k * _RUN + 1, F.least(F.lit(_RUN), n - k * _RUN)), empty, step))
        return F.when(n > 0, _with(runs, moved)).otherwise(F.array().cast(SPAN))

    def moved(runs: Column) -> Column:
        start = F.struct(F.lit(0).alias("end"), F.array().cast("array<int>").alias("out"))
        starts = F.aggregate(runs, start, lambda s, r: F.struct((s["end"] + r["end"]).cast("int").alias("end"), F.array_append(s["out"], s["end"]).alias("out")), lambda s: s["out"])
        return F.flatten(F.transform(F.arrays_zip(runs.alias("run"), starts.alias("start")), lambda r: F.transform(r["run"]["out"], lambda m: F.struct((m["at"] + r["start"]).cast("int").alias("at"), m["length"].alias("length"), m["surface"].alias("surface")))))

    return F.when(surfaces.isNotNull(), _with(F.arrays_zip(gaps.alias("gap"), surfaces.alias("surface")), in_runs))


def find_all(text: Column, pattern: str | Column) -> Column:
    """All matches of a regular expression from left to right, as an array of (at, length, surface).

    The pattern must not match the empty string; conditions on neighbours are filters on the result.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    surfaces = F.regexp_extract_all(text, pattern, 0)
    parts = F.split(text, pattern, -1)
    return _placed(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), surfaces)


def occurrences(text: Column, literal: str | Column) -> Column:
    """Places of a string's occurrences that do not overlap."""
    word = F.lit(literal) if isinstance(literal, str) else literal
    parts = F.split(text, F.concat(F.lit("\\Q"), word, F.lit("\\E")), -1)
    gaps = F.slice(parts, 1, F.size(parts) - 1)
    return F.transform(_placed(gaps, F.transform(gaps, lambda _: word)), lambda m: m["at"])


def alternation(words: list[str]) -> str:
    """One pattern in which, at each place, the longest word wins."""
    return "|".join(re.escape(w) for w in sorted(dict.fromkeys(words), key=len, reverse=True))


def dictionary_spans(segments: DataFrame, words: list[str], text: str = "text") -> DataFrame:
    """Longest words from left to right, never overlapping: one row per span with at, length, surface.

    The words are a curated roster; they become one literal pattern on the driver.
    """
    spans = F.inline(find_all(F.col(text), alternation(words)))
    return segments.where(F.col(text).rlike(alternation(words))).select("*", spans)


#: Words of one automaton; rosters are curated, and a larger list is an error rather than a driver out of memory.
MAX_WORDS = 1_000_000


def words_in(rows: DataFrame, text: str, words: list[str], name: str = "surface") -> DataFrame:
    """rows with each of the words that their text holds, once: one pass over a text for all words."""
    from pyspark.sql.types import StringType, StructField, StructType

    if len(words) > MAX_WORDS:
        raise ValueError(f"{len(words)} words; at most {MAX_WORDS} are sought at once")
    words = [w for w in words if w]
    schema = StructType([*rows.schema.fields, StructField(name, StringType())])
    place, names = rows.columns.index(text), [*rows.columns, name]

    def run(batches):
        import ahocorasick
        import pyarrow as pa

        automaton = ahocorasick.Automaton()
        for w in words:
            automaton.add_word(w, w)
        if words:
            automaton.make_automaton()
        for batch in batches:
            at, found = [], []
            for k, t in enumerate(batch.column(place).to_pylist()):
                own = sorted({w for _, w in automaton.iter(t)}) if t and words else []
                at += [k] * len(own)
                found += own
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(found, pa.string())], names=names)

    return rows.mapInArrow(run, schema)


def find_between(text: Column, pattern: str, excluded: Column) -> Column:
    """find_all() in what lies between excluded spans (at, length): no match starts in one or crosses it, and the search goes on behind it."""
    ordered = F.array_sort(F.transform(excluded, lambda e: F.struct(e["at"].cast("int").alias("at"), (e["at"] + e["length"]).cast("int").alias("end"))))
    gaps = F.transform(F.concat(ordered, F.array(F.struct(F.length(text).cast("int").alias("at"), F.length(text).cast("int").alias("end")))), lambda e, i: F.struct(F.when(i > 0, F.array_max(F.transform(F.slice(ordered, 1, i), lambda x: x["end"]))).otherwise(F.lit(0)).alias("from"), e["at"].alias("to")))
    free = F.filter(gaps, lambda g: g["to"] > g["from"])
    inside = lambda g: F.transform(find_all(F.substring(text, g["from"] + 1, g["to"] - g["from"]), pattern), lambda m: F.struct((m["at"] + g["from"]).cast("int").alias("at"), m["length"].alias("length"), m["surface"].alias("surface")))
    return F.flatten(F.transform(free, inside))


def distinct_in_order(lists: Column) -> Column:
    """The values of an array of arrays, each where it first appears."""
    return F.array_distinct(F.flatten(lists))


def overlap_anti(spans: DataFrame, others: DataFrame, key: str | list[str]) -> DataFrame:
    """Spans that overlap none of the others of the same key (at and end on both sides, ends exclusive)."""
    keys = [key] if isinstance(key, str) else key
    o = others.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("at").alias("_at"), F.col("end").alias("_end"))
    on = [spans[k] == F.col(f"_{k}") for k in keys] + [spans["at"] < F.col("_end"), spans["end"] > F.col("_at")]
    return spans.join(o, on, "left_anti")


def starting_outside(spans: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Spans that do not start inside any of the others of the same key."""
    o = others.select(F.col(key).alias("_key"), F.col("at").alias("_at"), F.col("end").alias("_end"))
    return spans.join(o, [spans[key] == F.col("_key"), spans["at"] >= F.col("_at"), spans["at"] < F.col("_end")], "left_anti")


def greedy(spans: Column) -> Column:
    """Of an array of structs with at and length, those that start at or behind the end of the last one kept; longest first where they tie."""
    ordered = F.array_sort(spans, lambda a, b: F.when(a["at"] != b["at"], a["at"] - b["at"]).otherwise(b["length"] - a["length"]).cast("int"))
    first = F.struct(F.lit(-1).alias("end"), F.filter(spans, lambda x: F.lit(False)).alias("out"))

    def step(state: Column, s: Column) -> Column:
        keep = s["at"] >= state["end"]
        return F.struct(F.when(keep, s["at"] + s["length"]).otherwise(state["end"]).cast("int").alias("end"), F.when(keep, F.array_append(state["out"], s)).otherwise(state["out"]).alias("out"))

    return F.aggregate(ordered, first, step, lambda s: s["out"])


def greedy_spans(spans: DataFrame, key: str | list[str]) -> DataFrame:
    """greedy() for each key; the spans of one segment are gathered, which its length bounds."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in spans.columns if c not in ("at", "length", *keys)]
    one = F.struct(F.col("at").cast("int").alias("at"), F.col("length").cast("int").alias("length"), *rest)
    return spans.groupBy(*keys).agg(F.collect_list(one).alias("_all")).select(*keys, F.inline(greedy(F.col("_all"))))


def carry(rows: DataFrame, group: list[str], order: str, window: int = 8) -> DataFrame:
    """Rows with `anchor` false that an anchor before them in the same group carries.

    A carried row renews the window: rows are cut into islands where more than `window` steps of the order lie
    between neighbours, and a row is carried if its island holds an anchor at a smaller place.
    """
    w = Window.partitionBy(*group).orderBy(order)
    gap = F.col(order) - F.lag(order).over(w) > window
    marked = rows.withColumn("_island", F.sum(F.when(gap, 1).otherwise(0)).over(w))
    before = Window.partitionBy(*group, "_island").orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    marked = marked.withColumn("_seen", F.coalesce(F.max(F.col("anchor").cast("int")).over(before), F.lit(0)))
    return marked.where("NOT anchor AND _seen = 1").drop("_island", "_seen")


def fill_forward(rows: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """The latest value that is not null, up to each row."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.last(value, ignorenulls=True).over(w))


def kth_pairs(left: DataFrame, right: DataFrame, group: list[str], left_order: list[str], right_order: list[str]) -> DataFrame:
    """The k-th row of the left with the k-th of the right in each group; what is left over on a side is dropped."""
    k = lambda order: F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return left.withColumn("k", k(left_order)).join(right.withColumn("k", k(right_order)), [*group, "k"])
