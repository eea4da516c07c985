"""Benchmark decontamination with one Aho-Corasick automaton.

The windows of all benchmark items form one automaton over normalised words. Each text is scanned
once; offsets of the normalised text lead back to words and to the original text. Documents are not
shuffled: the automaton is sent to the executors, and its size is bounded by MAX_PATTERN_BYTES. A benchmark
beyond the bound is read in parts, one after another, each an automaton of its own with a pass over the documents; the
driver and a task hold one part at a time, and what a pass has found is written to the shared folder.

Defined cases: a null or empty text, or one without word characters, has no words and no hits. Items
that are null or have no words have no windows. Items with the same id count once in n_items; an item
with a null id makes hits but is not listed. Repeated documents give repeated rows; other columns are
ignored (`contamination`) or kept (`clean`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, cut, drop_cut, text_bytes

WINDOW = 10
#: Bytes of window patterns in one automaton; about forty times as much is its memory.
MAX_PATTERN_BYTES = 4 << 20

#: A-Z to a-z; 0-9, a-z and bytes of non-ASCII characters stay; the rest separates words.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
SPANS = "doc_id long, item_id long, start long, end long, first_word long, last_word long"


def normal_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_NORMAL).split()


def patterns(items: Iterable[tuple[int | None, bytes | None]], window: int = WINDOW) -> dict[str, tuple[int, set]]:
    """Each window's normalised text with spaces around it -> its number of words and its item ids."""
    out: dict[str, tuple[int, set]] = {}
    for item_id, text in items:
        words = normal_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            own = words[i : i + window]
            out.setdefault(f" {b' '.join(own).decode('latin-1')} ", (len(own), set()))[1].add(item_id)
    return out


def parts(items: Iterable[tuple[int | None, bytes | None]], window: int = WINDOW, most: int = MAX_PATTERN_BYTES) -> Iterator[list[tuple[str, int, tuple]]]:
    """The patterns of as many items as keep an automaton below the bound (an item alone may exceed it); at least one part."""
    found: dict[str, tuple[int, set]] = {}
    size, any_ = 0, False
    for item in items:
        own = patterns([item], window)
        more = sum(map(len, own))
        if found and size + more > most:
            yield [(p, n, tuple(ids)) for p, (n, ids) in found.items()]
            found, size, any_ = {}, 0, True
        for p, (n, ids) in own.items():
            size += 0 if p in found else len(p)
            found.setdefault(p, (n, set()))[1].update(ids)
    if found or not any_:
        yield [(p, n, tuple(ids)) for p, (n, ids) in found.items()]


_BUILT: dict = {}


def _automaton(key: str, part):
    """The automaton of this worker, built once."""
    if key not in _BUILT:
        import ahocorasick

        _BUILT.clear()
        a = ahocorasick.Automaton()
        for p, n, ids in part:
            a.add_word(p, (len(p), n, ids))
        if part:
            a.make_automaton()
        _BUILT[key] = a if part else None
    return _BUILT[key]


def _scan(automaton, words: list[bytes]) -> list[tuple[int, int, tuple]]:
    """(first word, word after the last, item ids) for each occurrence."""
    if not words or automaton is None:
        return []
    flat = f" {b' '.join(words).decode('latin-1')} "
    hits, starts = [], None
    for end, (length, n, ids) in automaton.iter(flat):
        if starts is None:
            starts = np.cumsum([0, *map(len, words)]) + np.arange(len(words) + 1)
        first = int(np.searchsorted(starts, end - length + 1))
        hits.append((first, first + n, ids))
    return hits


def _sent(items: DataFrame, window: int, most: int):
    """(key, broadcast) of each part, one at a time."""
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).toLocalIterator()
    for part in parts(((r[0], None if r[1] is None else bytes(r[1])) for r in rows), window, most):
        yield hashlib.sha256(repr(part).encode()).hexdigest(), items.sparkSession.sparkContext.broadcast(part)


#: A hit as three numbers: first word, word after the last, item id; and whether the id is null.
_HIT = np.dtype([("first", "<i8"), ("last", "<i8"), ("item", "<i8"), ("none", "?")])


def _scanned(docs: DataFrame, items: DataFrame, window: int, most: int, finish, schema: str) -> DataFrame:
    """finish(batch, texts, words, hits) over the documents, one scan of them for each part of the benchmark; the last scan finishes."""
    bound_batches(docs.sparkSession)
    now = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("hits", F.lit(None).cast("binary"))
    written, sent = None, _sent(items, window, most)
    part = next(sent)
    while part is not None:
        further = next(sent, None)

        def run(batches, part=part, last=further is None):
            automaton = _automaton(part[0], part[1].value)
            for batch in batches:
                texts = text_bytes(batch.column(1))
                words = [normal_words(t) for t in texts]
                hits = [(known or b"") + np.array([(a, b, 0 if i is None else i, i is None) for a, b, ids in _scan(automaton, w) for i in ids], _HIT).tobytes() for w, known in zip(words, batch.column(2).to_pylist(), strict=True)]
                if last:
                    yield finish(batch, texts, words, [np.frombuffer(h, _HIT) for h in hits])
                else:
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, pa.binary())], names=["doc_id", "text", "hits"])

        now = now.mapInArrow(run, schema if further is None else "doc_id long, text string, hits binary")
        if further is not None:
            now = cut(now, "scanned")
            if written is not None:
                drop_cut(written)
            written = now
        part = further
    return now


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = MAX_PATTERN_BYTES) -> DataFrame:
    """One row per document: words, hit words, occurring items, and whether anything was hit."""

    def finish(batch, texts, all_words, all_hits):
        n_words, n_hit, n_items, digests = [], [], [], []
        for words, hits in zip(all_words, all_hits, strict=True):
            covered = np.zeros(len(words) + 1 if len(hits) else 0, np.int64)
            np.add.at(covered, hits["first"], 1)
            np.add.at(covered, hits["last"], -1)
            ids = set(hits["item"][~hits["none"]].tolist())
            n_words.append(len(words))
            n_hit.append(int((np.cumsum(covered) > 0).sum()))
            n_items.append(len(ids))
            digests.append(hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digests, pa.string()), pa.array([x > 0 for x in n_hit], pa.bool_())],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )

    return _scanned(docs, items, window, most, finish, RESULT)


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = MAX_PATTERN_BYTES) -> DataFrame:
    """One row per occurrence and item; start and end are code points of the original text."""

    def finish(batch, texts, all_words, all_hits):
        import re

        word = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
        rows = []
        for doc_id, text, hits in zip(batch.column(0).to_pylist(), texts, all_hits, strict=True):
            if not len(hits):
                continue
            at = [m.span() for m in word.finditer(text)]
            points = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)  # code points up to each byte
            for first, last, item, none in dict.fromkeys(hits.tolist()):
                a, b = at[first][0], at[last - 1][1]
                rows.append((doc_id, None if none else item, int(points[a]) - 1, int(points[b - 1]), first, last - 1))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(6)], names=["doc_id", "item_id", "start", "end", "first_word", "last_word"])

    return _scanned(docs, items, window, most, finish, SPANS)


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = MAX_PATTERN_BYTES) -> DataFrame:
    """The documents without a hit, with all their columns. No join: the verdict is computed beside the row."""
    bound_batches(docs.sparkSession)
    at = docs.columns.index("text")
    now, written = docs, None
    for n, (key, sent) in enumerate(_sent(items, window, most)):

        def run(batches, key=key, sent=sent):
            automaton = _automaton(key, sent.value)
            for batch in batches:
                yield batch.filter(pa.array([not _scan(automaton, normal_words(t)) for t in text_bytes(batch.column(at))], pa.bool_()))

        if n:
            now = cut(now, "scanned")
            if written is not None:
                drop_cut(written)
            written = now
        now = now.mapInArrow(run, docs.schema)
    return now
