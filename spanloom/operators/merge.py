"""Layers of annotations: ids, order, replacing and appending."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import natural_key, type_rank


def with_ids(rows: DataFrame, anchor: str, tag: str, order: list[str], start: str | None = None) -> DataFrame:
    """rows with id `<anchor>.<tag><k>`, k counting from 1 (or behind `start`) within each anchor."""
    k = F.row_number().over(Window.partitionBy(anchor).orderBy(*order))
    if start:
        k = k + F.coalesce(F.col(start), F.lit(0))
    return rows.withColumn("id", F.concat(F.col(anchor).cast("string"), F.lit(f".{tag}"), k.cast("string")))


def replace_type(kept: DataFrame, new: DataFrame, kind: str) -> DataFrame:
    """All rows but those of one type, and the new ones: applying it twice changes nothing."""
    return kept.where((F.col("type") != kind) | F.col("type").isNull()).unionByName(new, allowMissingColumns=True)


def append(existing: DataFrame, new: DataFrame, anchor: str, tag: str, order: list[str]) -> DataFrame:
    """existing and new rows, whose ids go on behind the largest number of their anchor; rows at a taken (anchor, at) are left out."""
    number = F.regexp_extract("id", f"\\.{tag}(\\d+)$", 1).try_cast("int")
    last = existing.groupBy(anchor).agg(F.max(number).alias("_last"))
    first = Window.partitionBy(anchor, "at").orderBy(*order)
    free = new.join(existing.select(anchor, "at").distinct(), [anchor, "at"], "left_anti").withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    numbered = with_ids(free.join(last, anchor, "left"), anchor, tag, order, "_last").drop("_last")
    return existing.unionByName(numbered, allowMissingColumns=True)


def in_reading_order(rows: DataFrame) -> DataFrame:
    """Sorted by segment (numbers as numbers), place and type."""
    return rows.orderBy(natural_key(F.col("anchor")), "at", type_rank(F.col("type")), "id")
