from __future__ import annotations

import random

import numpy as np
from xxhash import xxh64_intdigest

from spanloom.llm import simhash
from spanloom.llm.common import table
from spanloom.llm.components import components


def brute_print(text, width=4):
    words = (text or "").encode().translate(simhash._LOWER).split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    ones = [0] * 64
    for g in grams:
        h = xxh64_intdigest(g, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def brute(rows, distance=4):
    prints = [brute_print(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                comp[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, f"{prints[i]:016x}", least.get(root(i))) for i, (d, _) in enumerate(rows)]


def test_small_cases(spark):
    base = " ".join(f"w{i % 17}x{i}" for i in range(300))
    rows = [(5, base), (9, base + " tail"), (2, base.upper()), (7, None), (3, ""), (4, " \t\n"), (8, "one two"), (8, "one two"), (1, "One  TWO"), (10, "É a b c d"), (11, "é a b c d"), (12, base.replace("w3x3", "new"))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    assert sorted(map(tuple, simhash.near_duplicates(df).collect())) == sorted(brute(rows))
    kept = [r.doc_id for r in simhash.deduplicate(df).collect()]
    assert sorted(kept) == sorted({c for _, _, c in brute(rows)})
    assert simhash.deduplicate(df).columns == df.columns


def test_null_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "c d e f g"), (4, "a b")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()} == {(None, 4), (None, None), (4, 4)}
    assert simhash.deduplicate(df).count() == 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0


def test_whole_table(spark, sf):
    docs = table(spark, sf, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect())) == sorted(want)
    assert len({c for _, _, c in want}) < len(want)


def test_buckets_lose_no_link():
    """Pigeonhole, pivots and the spanning search against all pairs, with a dense group in one large bucket."""
    rng = np.random.default_rng(3)
    for blocks in (6, 7, 8):
        fp = rng.integers(0, 1 << 64, 300, np.uint64, endpoint=False)
        centre = fp[0]
        near = np.array([centre ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))) for _ in range(200)])
        fp = np.unique(np.concatenate((fp, near)))
        got = np.zeros((len(fp), len(fp)), bool)
        for mask in simhash._masks(blocks, 4):
            order = np.argsort(fp & mask, kind="stable")
            for u, v in simhash.link_buckets((fp & mask)[order], fp[order], order):
                got[u, v] = got[v, u] = True
        want = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4
        assert not (got & ~want).any()
        reach = got | np.eye(len(fp), dtype=bool)
        for _ in range(10):
            reach = (reach.astype(int) @ reach.astype(int)) > 0
        assert reach[want].all()  # a link may be left to a path


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)] + [(200, 201 + i) for i in range(30)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    assert got == {n: root(n) for u, v in edges if u != v for n in (u, v)}
