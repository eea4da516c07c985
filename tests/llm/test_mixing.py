from __future__ import annotations

import numpy as np
import pytest

from spanloom.llm import mixing
from spanloom.llm.common import table


def test_both_rakings_meet_the_targets(spark):
    rng = np.random.default_rng(4)
    rows = [(f"s{i % 3}", f"l{i % 2}", f"t{i % 5}", int(rng.integers(1, 60))) for i in range(120)]
    df = spark.createDataFrame(rows, "source string, lang string, topic string, n_tokens long")
    targets = {"source": {"s0": 0.5, "s1": 0.3, "s2": 0.2, "absent": 9.0}, "lang": {"l0": 0.6, "l1": 0.4}}
    here = {tuple(r)[:3]: r.probability for r in mixing.rates(df, targets).collect()}
    spread = {tuple(r)[:3]: r.probability for r in mixing.rates(df, targets, local=0).collect()}
    assert here.keys() == spread.keys() and all(here[k] == pytest.approx(spread[k], rel=1e-4) for k in here)
    weight = {}
    for s, l, t, n in rows:
        for k in (s, l, t):
            weight[k] = weight.get(k, 0) + n * here[s, l, t]
    total = weight["s0"] + weight["s1"] + weight["s2"]
    assert weight["s0"] / total == pytest.approx(0.5, abs=1e-3) and weight["s1"] / total == pytest.approx(0.3, abs=1e-3)
    assert weight["l0"] / total == pytest.approx(0.6, abs=1e-3)
    assert max(here.values()) == pytest.approx(1) and min(here.values()) > 0


def test_cases(spark):
    rows = [(1, "a b c", None, "en"), (2, None, "s", None), (3, "", "s", "en"), (1, "a b c", None, "en"), (None, "x y", "s", "en")]
    df = spark.createDataFrame([(*r, "t", 0.5) for r in rows], "doc_id long, text string, source string, lang string, topic string, probability double")
    got = mixing.calibrate(df).collect()
    assert len(got) == 5 and all(0 <= r.probability <= 1 for r in got)
    assert {r.n_tokens for r in got if r.doc_id == 2} == {0}
    kept = mixing.sample(df)
    assert kept.columns == df.columns and kept.where("doc_id = 1").count() in (0, 2)
    assert mixing.calibrate(df.limit(0)).count() == 0


def test_sample_is_what_calibrate_keeps(spark, sf):
    docs = table(spark, sf, "documents")
    rows = mixing.calibrate(docs).collect()
    assert sorted(r.doc_id for r in mixing.sample(docs).collect()) == sorted(r.doc_id for r in rows if r.kept)
    assert len(rows) == docs.count() and 0 < sum(r.kept for r in rows) < len(rows)


def test_rare_cell_does_not_set_the_sample(spark):
    """A stray source leaves the kept share, and marginals that can be met are."""
    rows = [(f"s{i % 3}", f"l{i % 2}", f"t{i % 5}", 10_000 + 37 * i) for i in range(60)] + [("stray", "", "t0", 60)]
    df = spark.createDataFrame(rows, "source string, lang string, topic string, n_tokens long")
    here = {tuple(r)[:3]: r for r in mixing.rates(df, None).collect()}
    total = sum(r[3] for r in rows)
    kept = sum(r[3] * here[r[:3]].probability for r in rows)
    assert kept / total == pytest.approx(mixing.KEEP, rel=1e-3) == here["stray", "", "t0"].kept_share
    assert here["stray", "", "t0"].probability == pytest.approx(1)
    assert sum(n * here[s, la, t].probability for s, la, t, n in rows if s == "s0") / kept == pytest.approx(sum(n**0 for s, _, _, n in rows if s == "s0") / 60, abs=0.02)


def test_raking_by_its_definition(spark):
    """Probabilities are products of one factor for each category, cut at 1, whose tokens meet the targets: that is one solution only."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.calibrate(docs).collect()
    cells, tokens = {}, {}
    for r in rows:
        key = (r.source, r.lang, r.topic)
        cells[key] = r.probability
        tokens[key] = tokens.get(key, 0) + r.n_tokens
    total = sum(tokens.values())
    kept = sum(n * cells[k] for k, n in tokens.items())
    assert kept / total == pytest.approx(rows[0].kept_share, rel=1e-6) and kept / total >= mixing.KEEP - 1e-6
    for axis, power in enumerate(mixing.TEMPER.values()):
        has, stays, full = {}, {}, {}
        for k, n in tokens.items():
            has[k[axis]] = has.get(k[axis], 0) + n
            stays[k[axis]] = stays.get(k[axis], 0) + n * cells[k]
            full[k[axis]] = full.get(k[axis], True) and (cells[k] > 1 - 1e-9 or not n)
        goal = {c: (n / total) ** power for c, n in has.items() if n}
        whole = sum(goal.values())
        open_ = [c for c in goal if not full[c]]
        ratio = [stays[c] / (goal[c] / whole * kept) for c in open_]  # alike for all that are not exhausted
        assert max(ratio) / min(ratio) == pytest.approx(1, abs=1e-3)
    free = {k: p for k, p in cells.items() if 0 < p < 1 - 1e-9}
    tried = 0
    for (s, la, t), p in free.items():
        for s2, l2 in {(s2, l2) for s2, l2, t2 in free if t2 == t and s2 > s and l2 != la}:
            if (s, l2, t) in free and (s2, la, t) in free:
                assert p * free[s2, l2, t] == pytest.approx(free[s, l2, t] * free[s2, la, t], rel=1e-6)
                tried += 1
    assert tried > 20
