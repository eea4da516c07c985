"""Connected components of a distributed edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut


#: A node's edges are dealt to so many tasks.
SALTS = 8


def _salted(edges: DataFrame) -> DataFrame:
    return edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))


def _with_least(edges: DataFrame) -> DataFrame:
    """The edges with m, the smallest neighbour of u. Neither the minimum nor the join needs a hub's edges in one task."""
    salted = _salted(edges)
    least = salted.groupBy("u", "salt").agg(F.min("v").alias("m")).groupBy("u").agg(F.min("m").alias("m"))
    spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(spread, ["u", "salt"]).drop("salt")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    known = _with_least(down)
    return known.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(known.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest id reachable, for every node that has an edge.

    edges has columns u and v (long, any direction, repeats and loops allowed). Each round halves the
    distances at least; a round is written to the shared folder and the one before it deleted, so lost
    executors cost no more than a round. Rounds end when one changes no edge: the tables are compared, not a digest of them.
    """
    now = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    size = now.count()
    while size:
        after = cut(_small_star(_large_star(now)).distinct(), "edges")
        n = after.count()
        same = n == size and after.join(now, ["u", "v"], "left_anti").isEmpty()
        drop_cut(now)
        now, size = after, n
        if same:
            break
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
