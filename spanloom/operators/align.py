"""Alignment of two versions of a text, edit scripts and their classification."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import canonical_hash, normalized_hash

OPS = "array<struct<op:string,at:int,length:int,from:string,to:string,text:string>>"


def _script(a: str, b: str) -> list[dict]:
    from difflib import SequenceMatcher

    out = []
    for tag, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        row = {"op": tag, "at": i, "length": None, "from": None, "to": None, "text": None}
        if tag == "replace":
            out.append(row | {"length": j - i, "from": a[i:j], "to": b[k:m]})
        elif tag == "delete":
            out.append(row | {"length": j - i, "text": a[i:j]})
        elif tag == "insert":
            out.append(row | {"text": b[k:m]})
    return out


def edit_scripts(pairs: DataFrame, left: str, right: str, out: str = "ops") -> DataFrame:
    """pairs with the operations that turn the left text into the right one; offsets count the left's code points."""
    kept = pairs.schema
    arrow = None

    def run(batches):
        nonlocal arrow
        kind = arrow or pa.list_(pa.struct([("op", pa.string()), ("at", pa.int32()), ("length", pa.int32()), ("from", pa.string()), ("to", pa.string()), ("text", pa.string())]))
        for batch in batches:
            a, b = (batch.column(kept.names.index(c)).to_pylist() for c in (left, right))
            ops = pa.array([_script(x or "", y or "") for x, y in zip(a, b, strict=True)], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, ops], names=[*batch.schema.names, out])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return pairs.mapInArrow(run, f"{columns}, `{out}` {OPS}")


def apply_script(text: Column, ops: Column) -> Column:
    """The text after an edit script."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    size = lambda o: F.coalesce(o["length"], F.lit(0))

    def step(s: Column, o: Column) -> Column:
        before = F.substring(text, s["at"] + 1, o["at"] - s["at"])
        new = F.when(o["op"] == "replace", o["to"]).when(o["op"] == "insert", o["text"]).otherwise("")
        return F.struct(F.concat(s["out"], before, new).alias("out"), (o["at"] + size(o)).alias("at"))

    return F.aggregate(ops, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))


def script_error(text: Column, ops: Column) -> Column:
    """What is wrong with an edit script, null if nothing: order, bounds, or text that is not there."""
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast("string").alias("error"))
    size = lambda o: F.coalesce(o["length"], F.lit(0))

    def step(s: Column, o: Column) -> Column:
        there = F.substring(text, o["at"] + 1, size(o))
        wrong = (
            F.when(o["at"] < s["at"], "operations overlap or are out of order")
            .when((o["at"] < 0) | (o["at"] + size(o) > F.length(text)), "an operation lies outside the text")
            .when((o["op"] == "replace") & (there != o["from"]), "the replaced text is not there")
            .when((o["op"] == "delete") & (there != o["text"]), "the deleted text is not there")
        )
        return F.struct((o["at"] + size(o)).alias("at"), F.coalesce(s["error"], wrong).alias("error"))

    return F.aggregate(ops, start, step, lambda s: s["error"])


def classify(left: Column, right: Column, mapping: tuple[str, str] = ("", "")) -> Column:
    """equal, variant_char (equal without punctuation and with characters mapped) or textual."""
    same = canonical_hash(left) == canonical_hash(right)
    return F.when(same, "equal").when(normalized_hash(left, mapping) == normalized_hash(right, mapping), "variant_char").otherwise("textual")


def align(left: DataFrame, right: DataFrame, group: str, order: str, mapping: tuple[str, str] = ("", "")) -> DataFrame:
    """(group, left_no, right_no): paragraphs that correspond in two versions of each document, numbered from 0.

    Runs of equal normalised hashes pair up; between them, changed runs of equal size pair up by place. The sequence
    matcher needs a document's hashes in order; texts stay out of it.
    """

    def side(df: DataFrame) -> DataFrame:
        return df.select(F.col(group).alias("g"), F.col(order).alias("o"), normalized_hash(F.col("text"), mapping).alias("h"))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        from difflib import SequenceMatcher

        rows = []
        if len(a) and len(b):  # a side without rows has no columns either
            a, b = a.sort_values("o", kind="stable"), b.sort_values("o", kind="stable")
            for tag, i, j, k, m in SequenceMatcher(None, a["h"].tolist(), b["h"].tolist(), autojunk=False).get_opcodes():
                if tag == "equal" or (tag == "replace" and j - i == m - k):
                    rows += [(a["g"].iloc[0], i + n, k + n) for n in range(j - i)]
        return pd.DataFrame(rows, columns=[group, "left_no", "right_no"])

    return side(left).groupBy("g").cogroup(side(right).groupBy("g")).applyInPandas(run, f"{group} {left.schema[group].dataType.simpleString()}, left_no int, right_no int")


def align_by_hash(left: DataFrame, right: DataFrame, group: list[str], order: str, mapping: tuple[str, str] = ("", "")) -> DataFrame:
    """An approximation without order: the k-th left paragraph of a hash with the k-th right one."""
    k = lambda: F.row_number().over(Window.partitionBy(*group, "h").orderBy(order))
    side = lambda df, name: df.select(*group, F.col(order), normalized_hash(F.col("text"), mapping).alias("h")).withColumn("k", k()).withColumnRenamed(order, name)
    return side(left, "left_no").join(side(right, "right_no"), [*group, "h", "k"]).select(*group, "left_no", "right_no")


def summary(left: DataFrame, right: DataFrame, pairs: DataFrame, group: str) -> DataFrame:
    """Per document: paragraphs on both sides, aligned ones and those left over."""
    n = lambda df, name: df.groupBy(group).agg(F.count(F.lit(1)).alias(name))
    out = n(left, "n_left").join(n(right, "n_right"), group, "full").join(n(pairs, "n_aligned"), group, "left").na.fill(0)
    return out.withColumn("n_left_over", F.col("n_left") - F.col("n_aligned")).withColumn("n_right_over", F.col("n_right") - F.col("n_aligned"))


def unaligned(left: DataFrame, right: DataFrame, pairs: DataFrame, group: str, order: str) -> DataFrame:
    """(group, side, place): paragraphs of either version that have no partner; places are those of align()."""
    place = lambda df: df.select(group, (F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1).alias("place"))
    rest = lambda df, name: place(df).join(pairs.select(group, F.col(f"{name}_no").alias("place")), [group, "place"], "left_anti").select(group, F.lit(name).alias("side"), "place")
    return rest(left, "left").unionByName(rest(right, "right"))
