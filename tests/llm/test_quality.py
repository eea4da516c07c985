from __future__ import annotations

import random
import re

import numpy as np

from spanloom.llm import quality
from spanloom.llm.common import table

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    t = text or ""
    words = WORD.findall(t)
    runs = {}
    for i in range(len(words) - 4):
        runs.setdefault(tuple(words[i : i + 5]), []).append(i)
    hit = {k for at in runs.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    seen, duplicate = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            duplicate += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), duplicate, len(hit), n < 10 or 100 * len(hit) > 20 * n


def test_statistics_of_all_kinds(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "a", "a b c d e " * 3, "x\x0by\x0cz\u3000w\u00a0v", "é|é\né|é\n\né|é", "one\ntwo\none \none", "𠀀 # $ <b> & %"]
    texts += [" ".join(rng.choice("abc") for _ in range(n)) + "\n" for n in range(0, 40, 3)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, kept int")
    got = {r.doc_id: tuple(r)[1:7] for r in quality.judge(df, spark.createDataFrame([], "doc_id long, quality int")).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_no_labels_reject_nothing_more(spark):
    df = spark.createDataFrame([(1, "word " * 3), (2, " ".join(map(str, range(30)))), (None, None), (2, " ".join(map(str, range(30))))], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (2, None)], "doc_id long, quality int")
    assert sorted(r.kept for r in quality.judge(df, labels).collect()) == [False, False, True, True]
    assert quality.clean(df, labels).count() == 2
    assert quality.judge(df.limit(0), labels).count() == 0


def test_whole_table_and_accuracy(spark):
    """On 1000 documents: statistics as by brute force; nearly all good documents stay and nearly all bad ones go."""
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = quality.judge(docs, labels).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(tuple(r)[1:7] == brute(texts[r.doc_id]) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)
    good = {r.doc_id: r.quality for r in labels.collect()}
    kept = {r.doc_id: r.kept for r in rows}
    failed = {r.doc_id: r.base_failed for r in rows}
    stay = [kept[d] for d, q in good.items() if q == 1 and not failed[d]]
    assert np.mean(stay) >= 0.99
    gone = [not kept[d] for d, q in good.items() if q == 0]
    assert np.mean(gone) >= 0.95
    assert {r.doc_id for r in quality.clean(docs, labels).collect()} == {d for d, k in kept.items() if k}


def test_accuracy_on_labels_held_out(spark):
    """The forest and its threshold see the labels of even ids only; those of odd ids judge them."""
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = {r.doc_id: r for r in quality.judge(docs, labels.where("doc_id % 2 = 0")).collect()}
    held = {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1").collect()}
    assert np.mean([rows[d].kept for d, q in held.items() if q == 1 and not rows[d].base_failed]) >= 0.95
    assert np.mean([not rows[d].kept for d, q in held.items() if q == 0]) >= 0.9


def test_repeated_ids_bring_one_row_each(spark):
    docs = spark.createDataFrame([(i % 3, " ".join(f"word{k * i}" for k in range(30))) for i in range(1, 301)], "doc_id long, text string")
    assert quality.fit(docs, spark.createDataFrame([(0, 1), (1, 1), (2, 1)], "doc_id long, quality int"))[0].size <= 3


def test_forest_separates_what_lies_apart():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (500, 3)), rng.normal(8, 1, (10, 3))])
    score = quality.Forest(x, seed=1).score(x)
    assert score[500:].min() > np.quantile(score[:500], 0.9)
    normal = quality.Forest(x[:500], x, seed=1).score(x)
    assert normal[500:].min() > np.quantile(normal[:500], 0.99)
    assert (quality.Forest(x, seed=1).score(x) == score).all()
    assert np.isfinite(quality.Forest(x[:1]).score(x)).all()
