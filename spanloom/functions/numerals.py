"""Numerals and era years as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = "一二三四五六七八九"


def _digit(c: Column) -> Column:
    """1 to 9, 元 as 1; null for anything else."""
    at = F.when(F.length(c) == 1, F.instr(F.lit(DIGITS), c))
    return F.when(c == "元", 1).when(at > 0, at)


def to_int(numeral: Column) -> Column:
    """1 to 99 of a numeral; null where it is not one."""
    parts = F.split(numeral, "十")
    head, tail = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    tens = F.when(head == "", F.lit(1)).otherwise(_digit(head))
    ones = F.when(tail == "", F.lit(0)).otherwise(_digit(tail))
    return F.when(F.size(parts) == 1, _digit(numeral)).when(F.size(parts) == 2, tens * 10 + ones).cast("int")


def to_month(numeral: Column) -> Column:
    n = F.when(numeral == "正", 1).otherwise(to_int(numeral))
    return F.when(n.between(1, 12), n)


def from_int(n: Column) -> Column:
    """The numeral of 1 to 99; other numbers in digits."""
    digit = lambda d: F.substring(F.lit("〇" + DIGITS), d.cast("int") + 1, F.lit(1))
    tens, ones = F.floor(n / 10), n % 10
    written = F.concat(F.when(tens > 1, digit(tens)).otherwise(""), F.when(tens > 0, "十").otherwise(""), F.when(ones > 0, digit(ones)).otherwise(""))
    return F.when(n.between(1, 99), written).otherwise(n.cast("string"))


def to_ad(start_ad: Column, era_year: Column) -> Column:
    return start_ad + era_year - 1


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("long")
