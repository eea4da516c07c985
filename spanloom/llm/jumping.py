"""Reachability along chains of pointers by pointer jumping: rounds grow with the logarithm of the longest chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut


def reach(starts: DataFrame, pointers: DataFrame, longest: int) -> DataFrame:
    """(scope, origin, at, dist) for all that is reached, the starts at distance 0.

    starts has scope, origin and at; pointers has scope, at and to, one row for each at. In round k every
    reached place jumps by 2**k pointers and every pointer is joined with its successor's, so both double. A
    round is written to the shared folder. More than `longest` steps mean a cycle, and jumping ends.
    """
    reached = cut(starts.select("scope", "origin", "at", F.lit(0).cast("long").alias("dist")), "reached")
    jump = cut(pointers.select("scope", "at", "to"), "jump")
    span = 1
    while span <= longest and not jump.isEmpty():
        further = reached.join(jump, ["scope", "at"]).select("scope", "origin", F.col("to").alias("at"), (F.col("dist") + span).alias("dist"))
        more = cut(reached.unionByName(further), "reached")
        double = cut(jump.join(jump.select("scope", F.col("at").alias("to"), F.col("to").alias("next")), ["scope", "to"]).select("scope", "at", F.col("next").alias("to")), "jump")
        drop_cut(reached)
        drop_cut(jump)
        reached, jump = more, double
        span *= 2
    return reached
