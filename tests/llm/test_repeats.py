"""Substring deduplication against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from spanloom.llm import repeats
from spanloom.llm.bwt import repeated_in_smaller


def brute(rows):
    first = {}
    for doc_id, text in rows:
        b = (text or "").encode()
        if doc_id is not None:
            for j in range(len(b) - 49):
                k = b[j : j + 50]
                first[k] = min(first.get(k, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - 49):
            if doc_id is not None and first[b[j : j + 50]] < doc_id:
                gone[j : j + 50] = b"\1" * 50
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, tag string, part int")
    return sorted((tuple(r) for r in repeats.removals(df).collect()), key=str)


def test_merge_agrees_with_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        length = rng.choice([1, 2, 4])
        strings = list(dict.fromkeys(bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 10))))
        owners = np.array([rng.randint(0, 4) for _ in strings])
        got = repeated_in_smaller(strings, owners, length, shard_symbols=rng.choice([5, 25, 1000]))
        for i, s in enumerate(strings):
            want = [any(s[j : j + length] in t for t, o in zip(strings, owners, strict=True) if o < owners[i]) for j in range(len(s) - length + 1)]
            assert got[i].tolist() == want


def test_documents_of_all_kinds(spark):
    rng = random.Random(3)
    words = ["alpha", "béta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "𠀀x", "iota"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, other = prose(30), prose(12)
    rows = [(i, prose(rng.randint(1, 60))) for i in range(40)]
    rows += [(100 + i, prose(8) + passage + prose(5)) for i in range(12)]
    rows += [(50, passage), (51, passage), (52, other + "\n" + other + "\n" + other), (3, other), (60, None), (61, ""), (62, "short"), (None, passage), (63, "a" * 49), (64, "a" * 300), (65, "a" * 51), (66, "a" * 50)]
    rows += [(50, passage), (70, passage + "one"), (70, passage + "two"), (71, passage[:60]), (-5, passage[5:])]
    assert run(spark, rows) == sorted(brute(rows), key=str)


def test_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 1000)
    rng = random.Random(9)
    text = bytes(rng.choice(b"abcd ") for _ in range(9000)).decode()
    whole = {(int(k), int(s) + j) for k, _, s, n in zip(*repeats.runs([text.encode()]), strict=True) for j in range(int(n))}
    monkeypatch.setattr(repeats, "PIECE", 1 << 20)
    once = {(int(k), int(s) + j) for k, _, s, n in zip(*repeats.runs([text.encode()]), strict=True) for j in range(int(n))}
    assert whole == once and len(once) == 9000 - 49


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("windows, want", [([(0, 1)], [(0, 50)]), ([(0, 1), (50, 51)], [(0, 100)]), ([(0, 2), (60, 61), (1, 5)], [(0, 54), (60, 110)])])
def test_runs_of_removed_bytes(windows, want):
    assert repeats.removed(200, np.array(windows)) == want
