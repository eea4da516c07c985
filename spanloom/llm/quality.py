"""Quality rules judged by an isolation forest.

Rule statistics of every whole text are computed in one pass without a shuffle. The forest is grown on
a bounded sample of labelled documents (`MAX_LABELLED`): on the good ones of two thirds, with splits over the range of
all labelled rows. Its anomaly threshold is calibrated on the good ones of the other third, which no tree has seen, so that no more than
`MAX_GOOD_REJECTED` of them are rejected; with fewer than LEAST_HELD of these, on all. The forest has a fixed size, so it is sent to the executors, which score each document beside its statistics.

Defined cases: a null or empty text has no words, fails the base rule and is rejected. Repeated
documents give repeated rows. Without labelled rows of good quality the forest rejects nothing.
Labels are taken once per doc_id (the lower quality where they differ); labels that are null or
without document are not used. Further columns are ignored (`judge`) or kept (`clean`).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, text_bytes

#: Labelled documents that the forest and its threshold may use: those with the smallest hash of doc_id.
MAX_LABELLED = 20_000
MAX_GOOD_REJECTED = 0.005
LEAST_HELD = 50
TREES, SUBSAMPLE, SEED = 100, 256, 7
MIN_WORDS, MAX_REPEAT_PERCENT, RUN = 10, 20, 5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATS = [*BASE, "n_lines"]
RESULT = ", ".join(["doc_id long", *(f"{c} long" for c in BASE), "base_failed boolean", "kept boolean", "anomaly double"])

_SPACE, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def repeat_words(words: list[bytes]) -> int:
    """Words inside runs of five words that occur at least twice in the list."""
    n = len(words) - RUN + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    runs = sum(h[i : n + i] * _MULT[i] for i in range(RUN))
    runs.sort()
    if not (runs[1:] == runs[:-1]).any():
        return 0
    first: dict[tuple, int] = {}  # equal hashes are seen; now the words themselves decide
    covered = np.zeros(len(words), bool)
    for i, run in enumerate(zip(*(words[k:] for k in range(RUN)), strict=False)):
        at = first.setdefault(run, i)
        if at != i:
            covered[i : i + RUN] = True
            covered[at : at + RUN] = True
    return int(covered.sum())


def statistics(text: bytes | None) -> tuple[int, ...]:
    """STATS of one text."""
    text = text or b""
    words = text.split()
    seen: set[bytes] = set()
    lines = duplicate = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            duplicate += line in seen
            seen.add(line)
    points = int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
    spaces = len(text) - len(text.translate(None, _SPACE))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    return len(words), points - spaces, symbols, duplicate, repeat_words(words), lines


def base_failed(stats: np.ndarray) -> np.ndarray:
    return (stats[:, 0] < MIN_WORDS) | (100 * stats[:, 4] > MAX_REPEAT_PERCENT * stats[:, 0])


def features(stats: np.ndarray) -> np.ndarray:
    """Ratios of the statistics, which do not depend on the text's length; those without a bound are on a log scale."""
    s = stats.astype(float)
    n, lines = np.maximum(s[:, 0], 1), np.maximum(s[:, 5], 1)
    return np.column_stack([np.log(np.maximum(s[:, 1] / n, 0.1)), np.log1p(10 * s[:, 2] / n), s[:, 3] / lines, s[:, 4] / n])


def _expected_depth(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


class Forest:
    """Random split trees as flat arrays; scores are 2 ** (-mean path length / expected length).

    Splits fall anywhere in the box that `x` and `seen` span, so that a place where no row of x lies is cut off soon. x
    has the rows that count as normal, and what lies among them is isolated late.
    """

    def __init__(self, x: np.ndarray, seen: np.ndarray | None = None, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED):
        rng = np.random.default_rng(seed)
        both = x if seen is None or not len(seen) else np.concatenate((x, seen))
        box = both.min(axis=0), both.max(axis=0)
        self.size = min(subsample, len(x))
        self.depth = int(np.ceil(np.log2(max(2, self.size))))
        self.trees = [self._grow(x[rng.choice(len(x), self.size, replace=False)], *box, rng) for _ in range(trees)]

    def _grow(self, x: np.ndarray, low: np.ndarray, high: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        feature, split, left, length = [], [], [], []
        level = [(x, low, high, 0)]
        nodes = 1
        while level:
            after = []
            for rows, low, high, depth in level:
                wide = np.flatnonzero(high > low)
                if depth >= self.depth or len(rows) < 2 or not len(wide):
                    feature.append(0)
                    split.append(np.inf)
                    left.append(len(feature) - 1)  # a leaf leads to itself
                    length.append(depth + _expected_depth(len(rows)))
                else:
                    f = int(rng.choice(wide))
                    at = rng.uniform(low[f], high[f])
                    feature.append(f)
                    split.append(at)
                    left.append(nodes)
                    length.append(0.0)
                    nodes += 2
                    below, middle = rows[:, f] <= at, np.where(np.arange(len(low)) == f, at, high)
                    above = np.where(np.arange(len(low)) == f, at, low)
                    after += [(rows[below], low, middle, depth + 1), (rows[~below], above, high, depth + 1)]
            level = after
        return np.array(feature), np.array(split), np.array(left), np.array(length)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, split, left, length in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = left[node] + (x[rows, feature[node]] > split[node])
            total += length[node]
        return 2.0 ** (-total / len(self.trees) / max(_expected_depth(self.size), 1e-9))


def _stats_in(batch, at: int) -> np.ndarray:
    return np.array([statistics(t) for t in text_bytes(batch.column(at))], np.int64).reshape(-1, len(STATS))


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, good_rejected: float = MAX_GOOD_REJECTED):
    """The forest and its threshold, or None where no labelled row is good."""
    bound_batches(docs.sparkSession)
    taken = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(taken), "doc_id").select("doc_id", "quality", "text")

    def measure(batches):
        for batch in batches:
            s = _stats_in(batch, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(s[:, k]) for k in range(len(STATS)))], names=["doc_id", "quality", *STATS])

    measured = labelled.mapInArrow(measure, "doc_id long, quality int, " + ", ".join(f"{c} long" for c in STATS))
    # one text for each id, so that repeated rows do not multiply what comes to the driver
    third = (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)) == 0).cast("int")
    got = measured.groupBy("doc_id").agg(F.min(F.struct("quality", *STATS)).alias("s")).select(third.alias("held"), "s.*").toPandas()
    got = got.sort_values(list(got.columns)).to_numpy().reshape(-1, 2 + len(STATS))
    held, quality, stats = got[:, 0] == 1, got[:, 1], got[:, 2:]
    passed = ~base_failed(stats)
    if not (passed & (quality == 1)).any():
        return None
    x, good = features(stats), passed & (quality == 1)
    apart = (good & held).sum() >= LEAST_HELD and (good & ~held).any()
    forest = Forest(x[good & ~held] if apart else x[good], x[passed])
    good = forest.score(x[good & held] if apart else x[good])
    return forest, float(np.quantile(good, 1 - good_rejected, method="higher"))


def _verdicts(model, stats: np.ndarray):
    failed = base_failed(stats)
    score = np.zeros(len(stats)) if model is None or not len(stats) else model[0].score(features(stats))
    return failed, score, ~failed & ((score <= model[1]) if model is not None else True)


def judge(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """One row per document: statistics, base rule, verdict and anomaly score."""
    model = fit(docs, labels, most)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            s = _stats_in(batch, 1)
            failed, score, kept = _verdicts(sent.value, s)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(s[:, k]) for k in range(len(BASE))), pa.array(failed), pa.array(kept), pa.array(score)],
                names=["doc_id", *BASE, "base_failed", "kept", "anomaly"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, RESULT)


def clean(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """The documents that are kept, with all their columns."""
    model = fit(docs, labels, most)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_verdicts(sent.value, _stats_in(batch, at))[2]))

    return docs.mapInArrow(run, docs.schema)
