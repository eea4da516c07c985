"""Exact substring deduplication over shard Burrows-Wheeler transforms.

Every byte covered by a LENGTH-byte string that also starts in a document with a smaller doc_id is marked.
Each window of LENGTH bytes is assigned to its minimizer, the K-byte string with the smallest hash in it;
equal windows have equal minimizers, so windows that can be equal meet in one bucket and no suffix order over the whole corpus is needed.

1. Documents with equal texts are collapsed to the one with the smallest id by the hash of the text.
2. Minimizers of the rest are compared: only those that occur in several documents go on. A task asks once per
   minimizer, however many of its documents hold it, so a passage of very many documents costs a bucket one entry per task.
3. The runs of windows around shared minimizers go to the minimizer's bucket, again once per task and content. There,
   contents that share the hash of a window go on (equal windows always do), and transforms of shards of the different contents are merged by interleave refinement (`bwt`), whose blocks
   with a common prefix of LENGTH are the repeated intervals.
4. Marked places return to their documents.

Defined cases: a null text is empty; a text below LENGTH bytes loses nothing. Rows that share a doc_id do not mark each other, and
each is judged on its own text. A null doc_id is neither smaller nor larger, so such rows lose and cause nothing. An empty
table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .bwt import repeated_in_smaller
from .common import bound_batches, text_bytes

LENGTH, K = 50, 24
SPAN = LENGTH - K + 1  # minimizer candidates in a window
PIECE = 1 << 20  # bytes that are hashed at once; places in a piece fit into the low bits of the order
MERGE_SYMBOLS = 1 << 18  # contents of about this many bytes are merged at once
_PLACE = np.uint64((1 << 24) - 1)
_TOLD = 0xFFFF
#: A multiplier to the powers 1, 2, 4 and 8, modulo 2 ** 64.
_B, _B2, _B4, _B8 = (np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in (1, 2, 4, 8))

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
ASKED = "part int, doc_id long, tag long, ids binary, tags binary, keys binary, owner binary"
SENT = "part int, doc_id long, tag long, ids binary, tags binary, keys binary, owner binary, at binary, size binary, text binary"
MARKS = "doc_id long, tag long, marks binary"
#: Declared without nulls, so that no join puts a filter of its own below the exchange and all of them share it.
PACKED = StructType([StructField("doc_id", LongType(), False), StructField("tag", LongType(), False), StructField("text", BinaryType(), False)])


def runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, text, start, windows): maximal runs of windows with the same minimizer; start is the first window's byte."""
    out = []
    begin = 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size + len(texts[end]) <= PIECE):
            size += len(texts[end])
            end += 1
        if end == begin + 1 and size > 2 * PIECE:  # pieces of one very long text; windows are dealt to pieces by their start
            text = texts[begin]
            for a in range(0, len(text), PIECE):
                key, own, start, n = _runs_in([text[a : a + PIECE + LENGTH - 1]])
                out.append((key, own + begin, start + a, n))
        else:
            key, own, start, n = _runs_in(texts[begin:end])
            out.append((key, own + begin, start, n))
        begin = end
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))


def _runs_in(texts: list[bytes]):
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data) - LENGTH + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    # a polynomial hash of K = 16 + 8 bytes by doubling
    h1 = data.astype(np.uint64) + np.uint64(1)
    h2 = h1[:-1] * _B + h1[1:]
    h4 = h2[:-2] * _B2 + h2[2:]
    h8 = h4[:-4] * _B4 + h4[4:]
    h16 = h8[:-8] * _B8 + h8[8:]
    m = len(data) - K + 1
    h = h16[:m] * _B8 + h8[16 : 16 + m]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    order = (h & ~_PLACE) | np.arange(m, dtype=np.uint64)
    least, width = order, 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[SPAN - width : SPAN - width + n])
    place = (least & _PLACE).astype(np.int64)
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)[:n]
    valid = np.arange(n) + LENGTH <= ends[text]
    change = np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | (valid[1:] != valid[:-1])))
    first = np.flatnonzero(change)
    count = np.diff(np.concatenate((first, [n])))
    keep = valid[first]
    first, count = first[keep], count[keep]
    own = text[first]
    return h[place[first]], own, first - (ends[own] - sizes[own]), count


def _squeeze(data: bytes) -> bytes:
    """Texts are compressed while they are shuffled."""
    from zstandard import ZstdCompressor

    return ZstdCompressor(3).compress(data)


def _expand(data: bytes) -> bytes:
    from zstandard import ZstdDecompressor

    return ZstdDecompressor().decompress(data)


def _short(key: np.ndarray) -> np.ndarray:
    return key >> np.uint64(16)


def _of(blob: bytes | None, kind) -> np.ndarray:
    return np.frombuffer(blob or b"", kind)


def _slices(n: int, most: int):
    return ((a, min(a + most, n)) for a in range(0, n, most))


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[t]) for k, (_, t) in enumerate(fields)], names=[c for c, _ in fields])


def _by_text(owner: np.ndarray, *values: np.ndarray):
    """The owners in order, and each one's values."""
    if not len(owner):
        return
    order = np.argsort(owner, kind="stable")
    owner = owner[order]
    at = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    for a, b in zip(at.tolist(), [*at[1:].tolist(), len(owner)], strict=True):
        yield int(owner[a]), *(v[order[a:b]] for v in values)


def _some(texts: list[bytes], most: int = 4 << 20):
    """(first, behind last) of texts that have about `most` bytes together, which bounds what runs() holds at once."""
    a, size = 0, 0
    for b, t in enumerate(texts, 1):
        size += len(t)
        if size >= most or b == len(texts):
            yield a, b
            a, size = b, 0


def _ask(parts: int):
    def run(batches):
        salt = 0
        for batch in batches:
            ids, tags = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            texts = [_expand(t) for t in batch.column(2).to_pylist()]
            for a, b in _slices(len(texts), _TOLD):
                asked = []
                for c, d in _some(texts[a:b]):
                    key, own, _, _ = runs(texts[a + c : a + d])
                    asked.append(np.unique((_short(key) << np.uint64(16)) | (own + c).astype(np.uint64)))
                both = np.sort(np.concatenate(asked))
                if not len(both):
                    continue
                key, own = both >> np.uint64(16), (both & np.uint64(0xFFFF)).astype(np.uint16)
                rows = []
                doc = ids[a:b][own]
                begins = np.concatenate(([True], key[1:] != key[:-1]))
                group = np.cumsum(begins) - 1
                first = np.flatnonzero(begins)
                differs = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
                shared = differs[group]
                for t, keys in _by_text(own[shared].astype(np.int64), key[shared]):
                    salt += 1
                    rows.append((salt * 7919 % parts, int(ids[a + t]), int(tags[a + t]), None, None, keys.tobytes(), None))
                told = np.where(differs, _TOLD, own[first]).astype(np.uint16)
                # rows of one doc_id with several texts must all be told
                extra = ~begins & ~shared
                key, own = np.concatenate((key[first], key[extra])), np.concatenate((told, own[extra]))
                order = np.argsort(key, kind="stable")
                key, own = key[order], own[order]
                for p, keys, owners in _by_text((key % np.uint64(parts)).astype(np.int64), key, own):
                    used, index = np.unique(owners, return_inverse=True)
                    real = used[used != _TOLD].astype(np.int64)
                    index = np.where(owners == _TOLD, _TOLD, index).astype(np.uint16)
                    rows.append((p, None, None, ids[a + real].tobytes(), tags[a + real].tobytes(), _packed(keys, parts), index.tobytes()))
                yield _table(rows, ASKED)

    return run


def _packed(keys: np.ndarray, parts: int) -> bytes:
    """Keys of one part in order, as differences of their quotients: four bytes each where these are small."""
    steps = np.diff(keys // np.uint64(parts), prepend=np.uint64(0))
    return b"\4" + steps.astype(np.uint32).tobytes() if int(steps.max()) < 1 << 32 else b"\10" + steps.tobytes()


def _unpacked(blob: bytes, part: int, parts: int) -> np.ndarray:
    steps = np.frombuffer(blob, np.uint32 if blob[0] == 4 else np.uint64, offset=1)
    return np.cumsum(steps, dtype=np.uint64) * np.uint64(parts) + np.uint64(part)


def _answers(parts: int):
    return lambda batches: _answer(batches, parts)


def _answer(batches, parts: int):
    """The minimizers that several documents hold, for each document that asked."""
    ids, tags, keys, owners, n = [], [], [], [], 0
    for batch in batches:
        told = []
        for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if r[3] is None:
                told.append((r[1], r[2], r[5]))
                continue
            ids.append(_of(r[3], np.int64))
            tags.append(_of(r[4], np.int64))
            owner = _of(r[6], np.uint16).astype(np.int64)
            owners.append(np.where(owner == _TOLD, -1, owner + n))
            keys.append(_unpacked(r[5], r[0], parts))
            n += len(ids[-1])
        if told:
            yield _table(told, MARKS)
    if not keys:
        return
    ids, tags, key, owner = (np.concatenate(x) for x in (ids, tags, keys, owners))
    order = np.argsort(key, kind="stable")
    key, owner = key[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    doc = np.where(owner >= 0, ids[np.maximum(owner, 0)], 0) if len(ids) else np.zeros(len(owner), np.int64)
    known = np.maximum.reduceat(owner < 0, first)
    several = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
    shared = np.repeat(known | several, np.diff(np.concatenate((first, [len(key)])))) & (owner >= 0)
    found = [(int(ids[d]), int(tags[d]), k.tobytes()) for d, k in _by_text(owner[shared], key[shared])]
    for a, b in _slices(len(found), 10_000):
        yield _table(found[a:b], MARKS)


def _send(parts: int):
    def run(batches):
        salt = 0
        for batch in batches:
            ids, tags = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            texts = [_expand(t) for t in batch.column(2).to_pylist()]
            wanted = [np.concatenate([_of(x, np.uint64) for x in blobs]) for blobs in batch.column(3).to_pylist()]
            for a, b in _slices(len(texts), _TOLD):
                kept = []
                for c, d in _some(texts[a:b]):
                    key, own, start, count = runs(texts[a + c : a + d])
                    want = np.concatenate([(w << np.uint64(16)) | np.uint64(i) for i, w in enumerate(wanted[a + c : a + d])])
                    take = np.isin((_short(key) << np.uint64(16)) | own.astype(np.uint64), want)
                    kept.append((key[take], own[take] + c, start[take], count[take]))
                key, own, start, count = (np.concatenate(x) for x in zip(*kept, strict=True))
                # a task sends each content for its smallest document only; larger ones are marked here
                least: dict[bytes, int] = {}
                content = [texts[a + o][s : s + c + LENGTH - 1] for o, s, c in zip(own.tolist(), start.tolist(), count.tolist(), strict=True)]
                docs = ids[a:b][own].tolist()
                for text, d in zip(content, docs, strict=True):
                    if d < least.get(text, d + 1):
                        least[text] = d
                later = np.fromiter((least[t] < d for t, d in zip(content, docs, strict=True)), bool, len(docs))
                rows = []
                for t, s, c in _by_text(own[later], start[later], count[later]):
                    salt += 1
                    rows.append((salt * 7919 % parts, int(ids[a + t]), int(tags[a + t]), None, None, None, None, None, None, np.column_stack([s, s + c]).tobytes()))
                sent = np.flatnonzero(~later)
                for p, i in _by_text((_short(key[sent]) % np.uint64(parts)).astype(np.int64), sent):
                    used, index = np.unique(own[i], return_inverse=True)
                    rows.append((p, None, None, ids[a + used].tobytes(), tags[a + used].tobytes(), key[i].tobytes(), index.astype(np.uint16).tobytes(), start[i].tobytes(), count[i].astype(np.uint32).tobytes(), _squeeze(b"".join(content[j] for j in i.tolist()))))
                if rows:
                    yield _table(rows, SENT)

    return run


def sharing(texts: list[bytes]) -> np.ndarray:
    """Whether each text may share a window with another one: by a hash of every window, which equal windows have in common."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(1)
    h, size = {1: data}, 1
    while 2 * size <= LENGTH:
        h[2 * size] = h[size][:-size] * np.uint64(pow(0x9E3779B97F4A7C15, size, 1 << 64)) + h[size][size:]
        size *= 2
    n = max(0, len(data) - LENGTH + 1)
    window, done = h[size][:n], size
    while done < LENGTH:
        part = 1 << ((LENGTH - done).bit_length() - 1)
        window = window * np.uint64(pow(0x9E3779B97F4A7C15, part, 1 << 64)) + h[part][done : done + n]
        done += part
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)[:n]
    whole = np.flatnonzero(np.arange(n) + LENGTH <= ends[text])
    window, text = window[whole], text[whole]
    order = np.argsort(window)
    window, text = window[order], text[order]
    new = np.flatnonzero(np.concatenate(([True], window[1:] != window[:-1])))
    out = np.zeros(len(texts), bool)
    if len(new):
        several = np.minimum.reduceat(text, new) != np.maximum.reduceat(text, new)
        out[text[np.repeat(several, np.diff(np.concatenate((new, [len(window)]))))]] = True
    return out


def _judge_buckets(batches):
    """Marked windows of each document, as (first, behind last) pairs."""
    ids, tags, keys, owners, starts, content, n = [], [], [], [], [], [], 0
    for batch in batches:
        known = []
        for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if r[3] is None:
                known.append((r[1], r[2], r[9]))
                continue
            ids.append(_of(r[3], np.int64))
            tags.append(_of(r[4], np.int64))
            keys.append(_of(r[5], np.uint64))
            owners.append(_of(r[6], np.uint16).astype(np.int64) + n)
            starts.append(_of(r[7], np.int64))
            n += len(ids[-1])
            at, text = 0, _expand(r[9])
            for c in _of(r[8], np.uint32).tolist():
                content.append(text[at : at + c + LENGTH - 1])
                at += c + LENGTH - 1
        if known:
            yield _table(known, MARKS)
    if not keys:
        return
    ids, tags, key, owner, start = (np.concatenate(x) for x in (ids, tags, keys, owners, starts))
    doc = ids[owner]
    number: dict[tuple, int] = {}
    which = np.fromiter((number.setdefault((k, t), len(number)) for k, t in zip(key.tolist(), content, strict=True)), np.int64, len(content))
    texts = [t for _, t in number]
    least = np.full(len(texts), np.iinfo(np.int64).max)
    np.minimum.at(least, which, doc)
    group = np.array([k for k, _ in number], np.uint64)
    order = np.argsort(group, kind="stable")
    begins = np.flatnonzero(np.concatenate(([True], group[order][1:] != group[order][:-1])))
    marks: dict[int, np.ndarray] = {}
    several = [order[a:b].tolist() for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(order)], strict=True) if b - a > 1]
    batch, symbols = [], 0
    for k, members in enumerate(several):
        batch += members
        symbols += sum(len(texts[i]) for i in members)
        if symbols >= MERGE_SYMBOLS or k == len(several) - 1:
            batch = np.array(batch)[sharing([texts[i] for i in batch])].tolist()
            if batch:
                marks.update(zip(batch, repeated_in_smaller([texts[i] for i in batch], least[batch], LENGTH), strict=True))
            batch, symbols = [], 0
    out_owner, out_from, out_to = [], [], []
    for i, (w, d, o, s) in enumerate(zip(which.tolist(), doc.tolist(), owner.tolist(), start.tolist(), strict=True)):
        n = len(content[i]) - LENGTH + 1
        if d > least[w]:
            out_owner.append(o)
            out_from.append(s)
            out_to.append(s + n)
        elif w in marks and marks[w].any():
            edge = np.flatnonzero(np.diff(np.concatenate(([False], marks[w], [False])).astype(np.int8)))
            out_owner += [o] * (len(edge) // 2)
            out_from += (s + edge[::2]).tolist()
            out_to += (s + edge[1::2]).tolist()
    pairs = np.column_stack([np.array(out_from, np.int64), np.array(out_to, np.int64)])
    found = [(int(ids[o]), int(tags[o]), p.tobytes()) for o, p in _by_text(np.array(out_owner, np.int64), pairs)]
    for a, b in _slices(len(found), 10_000):
        yield _table(found[a:b], MARKS)


def removed(n: int, windows: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the marked windows cover."""
    out: list[tuple[int, int]] = []
    for a, b in windows[np.argsort(windows[:, 0], kind="stable")].tolist():
        b += LENGTH - 1
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _pack(batches):
    from zstandard import ZstdCompressor

    squeeze = ZstdCompressor(3).compress
    for batch in batches:
        texts = pa.array([squeeze(t) for t in text_bytes(batch.column(2))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["doc_id", "tag", "text"])


def _report(batches):
    for batch in batches:
        rows = []
        for text, copy, marks in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            text = _expand(text)
            if copy and len(text) >= LENGTH:
                spans = [(0, len(text))]
            else:
                spans = removed(len(text), np.concatenate([_of(m, np.int64).reshape(-1, 2) for m in marks])) if marks else []
            rest = hashlib.sha256()
            at = 0
            for a, b in spans:
                rest.update(text[at:a])
                at = b
            rest.update(text[at:])
            rows.append((len(text), sum(b - a for a, b in spans), len(spans), rest.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)), pa.array([r[3] for r in rows], pa.string())],
            names=[c.split()[0] for c in RESULT.split(", ")],
        )


def removals(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes, removed runs, and the SHA-256 of what is left.

    Compressed texts are shuffled once, by document; all steps that need them read that one exchange.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks, parts = 3 * n, 8 * n  # given, so that small ones are not put together: a task holds its buckets
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("tag", F.xxhash64("text"))
    known = own.where("doc_id IS NOT NULL")
    whole = known.select("doc_id", "tag", F.sha2("text", 256).alias("sha"))
    first = whole.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "first")
    copies = whole.join(first, "sha").where("first < doc_id").select("doc_id", "tag", F.lit(True).alias("copy")).distinct()
    pack = lambda df, kind: df.select("doc_id", "tag", "text").mapInArrow(_pack, kind)
    by_id = pack(known, PACKED).join(copies, ["doc_id", "tag"], "left")
    fresh = by_id.where("copy IS NULL").select("doc_id", "tag", "text")
    gather = lambda df, name: df.groupBy("doc_id", "tag").agg(F.collect_list("marks").alias(name))
    shared = gather(fresh.mapInArrow(_ask(parts), ASKED).repartition(tasks, "part").mapInArrow(_answers(parts), MARKS), "keys")
    sent = fresh.join(shared, ["doc_id", "tag"]).select("doc_id", "tag", "text", "keys").mapInArrow(_send(parts), SENT)
    marks = gather(sent.repartition(tasks, "part").mapInArrow(_judge_buckets, MARKS), "marks")
    judged = by_id.join(marks, ["doc_id", "tag"], "left").select("doc_id", "text", "copy", "marks")
    nameless = pack(own.where("doc_id IS NULL"), "doc_id long, tag long, text binary").select("doc_id", "text", F.lit(None).cast("boolean").alias("copy"), F.lit(None).cast("array<binary>").alias("marks"))
    return judged.unionByName(nameless).mapInArrow(_report, RESULT)
