from __future__ import annotations

import hashlib
import re

from spanloom.llm import decontaminate
from spanloom.llm.common import table

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    found = []
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            found.append((item_id, w[i : i + window]))
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, ids = set(), set()
        for item_id, own in found:
            for i in range(len(w) - len(own) + 1):
                if w[i : i + len(own)] == own:
                    hit.update(range(i, i + len(own)))
                    ids.add(item_id)
        ids.discard(None)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest(), bool(hit)))
    return out


ITEMS = [(1, "What is the capital of France, and why is it there at all?"), (2, "Short one"), (10, "ÀB c"), (3, None), (4, "?!"), (2, "short ONE"), (None, "null id item"), (5, "a b c d e f g h i j")]
DOCS = [
    (1, "So: what IS the capital of France and why is it there at all - who knows"),
    (2, "short one, short one. shortone"), (3, None), (4, ""), (5, "…"), (6, "a b c d e f g h i j a b c d e f g h i j"),
    (7, "x Àb C y null id item"), (8, "a b c d e f g h i"), (1, "short one"), (None, "short one"), (9, "capital of France and why is it there at all"),
]


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n_hit int"),
        spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string"),
    )


def test_small_cases(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    got = sorted(map(tuple, decontaminate.contamination(docs, items).collect()), key=str)
    assert got == sorted(brute(DOCS, ITEMS), key=str)


def test_several_automata(spark):
    """Benchmarks beyond an automaton's bound are read in parts, with the same results."""
    docs, items = frames(spark, DOCS, ITEMS)
    assert len(list(decontaminate.parts([(i, None if t is None else t.encode()) for i, t in ITEMS], most=20))) > 2
    got = sorted(map(tuple, decontaminate.contamination(docs, items, most=20).collect()), key=str)
    assert got == sorted(brute(DOCS, ITEMS), key=str)
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert key(decontaminate.clean(docs, items, most=20)) == key(decontaminate.clean(docs, items))
    assert key(decontaminate.occurrences(docs, items, most=20)) == key(decontaminate.occurrences(docs, items))


def test_empty_tables(spark):
    docs, items = frames(spark, [], ITEMS)
    assert decontaminate.contamination(docs, items).count() == 0
    docs, items = frames(spark, DOCS, [])
    assert decontaminate.contamination(docs, items).where("contaminated").count() == 0
    assert decontaminate.clean(docs, items).count() == len(DOCS)


def test_whole_table(spark, sf):
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    got = sorted(map(tuple, decontaminate.contamination(docs, items).collect()))
    want = sorted(brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]))
    assert got == want and any(r[5] for r in got)
    kept = {r.doc_id for r in decontaminate.clean(docs, items).collect()}
    assert kept == {r[0] for r in want if not r[5]}


def test_occurrences_point_into_the_original(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    rows = decontaminate.occurrences(docs, items).where("doc_id = 7").collect()
    assert {(r.item_id, DOCS[6][1][r.start : r.end]) for r in rows} == {(10, "Àb C"), (None, "null id item")}
