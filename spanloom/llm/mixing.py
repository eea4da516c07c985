"""Mixing sources to target weights by iterative proportional fitting.

Token counts are gathered per cell (source, language, topic) with partial aggregation, so a source
that holds a third of all rows costs one row per task. The cell weights are then raked: scaled to each
marginal's target in turn until all marginals agree. A document's probability is its cell's raked
weight over the cell's tokens, scaled so that KEEP of all tokens are expected to stay (more, where more stay with the largest probability at 1).
Cells that would need more than they have get probability 1 and the rest is raked again to the same marginals; a category that has
too few tokens for its target gives all of them, and the others of its axis share what is missing. So a rare cell
does not decide how much of the corpus stays. A document is kept if the hash of its id falls below its probability. Up to MAX_LOCAL_CELLS cells are raked in memory; more stay in tables, where
each step of a raking pass is a join of cells with one marginal. Both give the same weights.

Defined cases: null source, language or topic are categories of their own (`''` in the targets); null or
empty texts have no tokens and take their cell's probability (0 where the cell has no tokens). A target
category without cells is left out and the rest rescaled; a category that has cells but no target keeps its share of
tokens. Equal ids share one draw, so copies of a row are kept or dropped together, and so do all rows whose id is null. An empty table gives
an empty result. Further columns are ignored (`calibrate`) or kept (`sample`).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut

AXES = ["source", "lang", "topic"]
TOLERANCE = 1e-6
#: Raking goes on while the largest error of a marginal falls by a hundredth at least within so many passes.
PATIENCE = 10
#: A marginal's target shares are proportional to its token shares to this power.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.7}
SEED = 11
#: Least share of all tokens that is expected to stay.
KEEP = 0.5
_FAR = 1e12  # bound of a rate and of its inverse


def n_tokens(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """A coarse topic from the text's form: table, numeric, list or prose.

    Only the characters' kinds decide, so it is the same in all languages.
    """
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))
    share = lambda cut_set: (F.length(t) - F.length(F.translate(t, cut_set, ""))) / n
    lines = F.length(t) - F.length(F.replace(t, F.lit("\n"))) + 1
    return (
        F.when(share("|\t") >= 0.02, "table")
        .when(share("0123456789") >= 0.05, "numeric")
        .when(n / lines < 80, "list")
        .when(n < 2000, "short prose")
        .otherwise("long prose")
    )


def axis_targets(cells: DataFrame, axis: str, given: dict[str, float] | None) -> DataFrame:
    """(category, target): the given shares or tempered shares of tokens, normalised over categories with cells."""
    t = cells.groupBy(F.col(axis).alias("category")).agg(F.sum("tokens").cast("double").alias("t"))
    total = t.agg(F.sum("t")).first()[0] or 1.0
    share = F.col("t") / F.lit(total)
    if given is None:
        t = t.select("category", F.pow(share, TEMPER[axis]).alias("t"))
    else:
        rows = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in given.items()], "category string, wanted double")
        t = t.join(rows, "category", "left").select("category", F.coalesce("wanted", share).alias("t"))
    total = t.agg(F.sum("t")).first()[0] or 1.0
    return t.select("category", (F.col("t") / F.lit(total)).alias("target"))


def reachable(goals: DataFrame, cells: DataFrame, axis: str, wanted: float) -> DataFrame:
    """(category, target) in tokens, `wanted` together: a category without enough gives all it has, and the others share the rest by their goals."""
    own = cut(goals.join(cells.groupBy(F.col(axis).alias("category")).agg(F.sum("tokens").alias("has")), "category"), f"reach-{axis}")
    scale, before = wanted, None
    while scale != before:
        full = F.col("has") <= F.col("target") * F.lit(scale)
        given, left = own.agg(F.sum(F.when(full, F.col("has")).otherwise(0)).cast("double"), F.sum(F.when(full, 0.0).otherwise(F.col("target")))).first()
        before, scale = scale, max(scale, (wanted - given) / left) if left else scale
    return own.select("category", F.least(F.col("has").cast("double"), F.col("target") * F.lit(scale)).alias("target"))


def reachable_here(goals: np.ndarray, has: np.ndarray, wanted: float) -> np.ndarray:
    """reachable() in memory."""
    scale, before = wanted, None
    while scale != before:
        full = has <= goals * scale
        left = goals[~full].sum()
        before, scale = scale, max(scale, (wanted - has[full].sum()) / left) if left else scale
    return np.minimum(has, goals * scale)


class _Progress:
    """Whether another pass may still help."""

    def __init__(self, tolerance: float):
        self.tolerance, self.best, self.since = tolerance, float("inf"), 0

    def done(self, error: float) -> bool:
        self.since = 0 if error < 0.99 * self.best else self.since + 1
        self.best = min(self.best, error)
        return error <= self.tolerance or self.since >= PATIENCE


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = TOLERANCE, bounded: bool = False) -> DataFrame:
    """cells(axes..., tokens and, to go on from, rate) with `rate`, so that tokens * rate meet the targets of every axis.

    A pass scales by each axis once; the largest relative error decides when to stop (within the tolerance, or no longer falling: targets that no rates can meet together). A pass adds joins to
    the plan, so every pass is written to the shared folder and the one before it is deleted. With `bounded`, rates above 1
    count as 1, and a step is Newton's for the category's factor, or a lower bound of the factor where it is below 1.
    """
    now = cut(cells if "rate" in cells.columns else cells.withColumn("rate", F.lit(1.0)), "rake")
    progress = _Progress(tolerance)
    while True:
        step = now.withColumn("error", F.lit(0.0))
        for axis, target in targets.items():
            all_ = F.col("tokens") * F.col("rate")
            has = F.col("tokens") * F.least(F.col("rate"), F.lit(1.0)) if bounded else all_
            slack = F.when(F.col("rate") < 1, all_).otherwise(0.0) if bounded else all_
            sums = step.groupBy(axis).agg(F.sum(has).alias("has"), F.sum(slack).alias("slack"), F.sum(all_).alias("all")).join(target.withColumnRenamed("category", axis), axis)
            newton = F.when(F.col("slack") > 0, 1 + (F.col("target") - F.col("has")) / F.col("slack"))
            factor = F.when(F.col("has") < F.col("target"), F.coalesce(newton, F.lit(1.0))).otherwise(F.greatest(newton, F.col("target") / F.col("all")))
            sums = sums.withColumn("factor", F.when(F.col("has") > 0, factor).otherwise(1.0))
            step = (
                step.join(sums, axis)
                .withColumn("error", F.greatest("error", F.when(F.col("has") > 0, F.abs(F.col("has") / F.col("target") - 1)).otherwise(0.0)))
                .withColumn("rate", F.least(F.greatest(F.col("rate") * F.col("factor"), F.lit(1 / _FAR)), F.lit(_FAR)))
                .drop("has", "slack", "all", "target", "factor")
            )
        after = cut(step, "rake")
        drop_cut(now)
        now = after.drop("error")
        now._written = after._written
        worst = after.where("tokens > 0").agg(F.max("error")).first()[0]
        if worst is None or progress.done(worst):
            break
    return now


def rake_here(tokens: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray], tolerance: float = TOLERANCE, rate: np.ndarray | None = None, bounded: bool = False) -> np.ndarray:
    """rake() in memory, for cells below the bound: the rates. codes: each axis' category numbers."""
    rate = np.ones(len(tokens)) if rate is None else rate
    progress = _Progress(tolerance)
    while True:
        worst = 0.0
        for code, target in zip(codes, targets, strict=True):
            sums = lambda x, c=code, n=len(target): np.bincount(c, x, n)
            all_ = sums(tokens * rate)
            has, slack = (sums(tokens * np.minimum(rate, 1)), sums(np.where(rate < 1, tokens * rate, 0))) if bounded else (all_, all_)
            live = has > 0
            worst = max(worst, float(np.abs(has[live] / target[live] - 1).max(initial=0)))
            safe = lambda x: np.where(x > 0, x, 1)
            newton = np.where(slack > 0, 1 + (target - has) / safe(slack), np.where(has < target, 1, 0))
            factor = np.where(has < target, newton, np.maximum(newton, target / safe(all_)))
            rate = np.clip(rate * np.where(live, factor, 1)[code], 1 / _FAR, _FAR)
        if progress.done(worst):
            break
    return rate


def miss(rows: DataFrame, targets: dict[str, DataFrame]) -> float:
    """The largest relative error of a marginal of rows(axes..., tokens, probability); targets are shares."""
    total = rows.agg(F.sum(F.col("tokens") * F.col("probability"))).first()[0] or 0.0
    worst = 0.0
    for axis, target in targets.items():
        has = rows.groupBy(F.col(axis).alias("category")).agg(F.sum(F.col("tokens") * F.col("probability")).alias("has"))
        off = has.join(target, "category").where("target > 0").agg(F.max(F.abs(F.col("has") / (F.col("target") * F.lit(total or 1.0)) - 1))).first()[0]
        worst = max(worst, off or 0.0)
    return worst


def _blank(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _blank("source").alias("source"), _blank("lang").alias("lang"), topic(F.col("text")).alias("topic"), n_tokens(F.col("text")).alias("n_tokens"))


def _draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11) / F.lit(float(1 << 53))


#: Cells up to this many are raked in the driver and sent to every executor; more stay in tables throughout.
MAX_LOCAL_CELLS = 200_000


def rates(rows: DataFrame, targets: dict[str, dict[str, float]] | None, local: int = MAX_LOCAL_CELLS, keep: float = KEEP) -> DataFrame:
    """(axes..., probability, kept_share) for each cell of rows(axes..., n_tokens). kept_share: of all tokens, expected."""
    spark, targets = rows.sparkSession, targets or {}
    cells = cut(rows.groupBy(*AXES).agg(F.sum("n_tokens").alias("tokens")), "cells")
    goals = {a: axis_targets(cells, a, targets.get(a)) for a in AXES}
    got = cells.limit(local + 1).toPandas()
    if len(got) > local:
        goals = {a: cut(g, f"target-{a}") for a, g in goals.items()}
        done = rake(cells, goals)
        full = F.col("tokens") > 0
        top, total = done.agg(F.max(F.when(full, F.col("rate"))), F.sum("tokens").cast("double")).first()
        scale = 1 / (top or 1.0)
        if total and scale < keep * total:  # the rates' tokens are 1 together
            wanted = {a: reachable(g, cells, a, keep * total) for a, g in goals.items()}
            done, scale = rake(done.withColumn("rate", F.col("rate") * F.lit(keep * total)), wanted, bounded=True), 1.0
        done = cut(done.select(*AXES, "tokens", F.when(full, F.least(F.col("rate") * F.lit(scale), F.lit(1.0))).otherwise(0.0).alias("probability")), "rates")
        share = (done.agg(F.sum(F.col("tokens") * F.col("probability"))).first()[0] or 0.0) / (total or 1.0)
        return done.select(*AXES, "probability", F.lit(share).alias("kept_share"))
    got = got.sort_values(AXES).reset_index(drop=True)
    codes, wanted = [], []
    for a in AXES:
        goal = dict(goals[a].toPandas().itertuples(index=False))
        names = sorted(goal)
        codes.append(got[a].map({n: k for k, n in enumerate(names)}).to_numpy(dtype=int))
        wanted.append(np.array([goal[n] for n in names], float))
    tokens = got["tokens"].to_numpy(dtype=float)
    rate, full, total = rake_here(tokens, codes, wanted), tokens > 0, tokens.sum()
    scale = 1 / (rate[full].max(initial=0) or 1.0)
    if scale < keep * total:  # the rates' tokens are 1 together
        wanted = [reachable_here(g, np.bincount(c, tokens, len(g)), keep * total) for g, c in zip(wanted, codes, strict=True)]
        rate, scale = rake_here(tokens, codes, wanted, rate=rate * keep * total, bounded=True), 1.0
    got["probability"] = np.where(full, np.minimum(rate * scale, 1), 0)
    got["kept_share"] = float((tokens * got["probability"]).sum() / (total or 1.0))
    out = spark.createDataFrame([tuple(r) for r in got[[*AXES, "probability", "kept_share"]].itertuples(index=False)], "source string, lang string, topic string, probability double, kept_share double")
    return F.broadcast(out)


def calibrate(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, seed: int = SEED) -> DataFrame:
    """One row per document: cell, tokens, probability, whether it is kept, and the share of all tokens that is expected to stay."""
    rows = cut(_prepared(docs), "cells-of-rows")  # texts are read once; their cells and token counts are a few bytes each
    kept = _draw(F.col("doc_id"), seed) < F.col("probability")
    return rows.join(rates(rows, targets), AXES, "left").select("doc_id", *AXES, "n_tokens", "probability", kept.alias("kept"), "kept_share")


def sample(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, seed: int = SEED) -> DataFrame:
    """The kept documents with all their columns. Ids decide, so no text is shuffled."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), _blank("source").alias("source"), _blank("lang").alias("lang"), topic(F.col("text")).alias("topic"))
    kept = rows.join(rates(_prepared(docs), targets), AXES).where(_draw(F.col("row.doc_id").cast("long"), seed) < F.col("probability"))
    return kept.select("row.*")
