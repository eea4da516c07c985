"""SimHash near-duplicates with pivot distance tables.

A fingerprint is computed for every whole text; equal fingerprints collapse to one row before any pair
is looked for. Candidates meet in buckets that agree in some blocks of the fingerprint, chosen so that
each pair within the distance agrees in at least one choice (pigeonhole). In a bucket, the distances of
its fingerprints to many reference fingerprints (pivots) are tabled; a pair is discarded where a coordinate differs by
more than the threshold (triangle inequality), and survivors are verified. A bucket yields edges that span its linked groups,
never all pairs, and linked groups are joined by distributed connected components.

A pivot table alone cannot avoid comparing each pair's coordinates, so the block choices stand before it; both
steps are exact. A bucket above SMALL is searched breadth first, which visits each fingerprint once and
compares it with those not yet reached.

Defined cases: a null text or one without words has fingerprint zero and links like any other. Repeated rows
give repeated rows; a null doc_id gets a fingerprint and the component of the ids that share it. Further columns are
ignored (`near_duplicates`) or kept (`deduplicate`).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, cut, text_bytes
from .components import components

SHINGLE, DISTANCE, PIVOTS, SMALL = 4, 4, 24, 64
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PIVOT = np.random.default_rng(64).integers(0, 1 << 64, PIVOTS, np.uint64, endpoint=False)


def fingerprints_of(texts: list[bytes | None], width: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text."""
    from xxhash import xxh64_intdigest

    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        words = (text or b"").translate(_LOWER).split()
        if not words:
            continue
        if len(words) <= width:
            hashes.append(xxh64_intdigest(b" ".join(words), 42))
            counts[k] = 1
            continue
        flat = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1].tolist()
        hashes += [xxh64_intdigest(flat[a:b], 42) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)]
        counts[k] = len(words) - width + 1
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        at = np.concatenate(([0], np.cumsum(counts[full])))
        h = np.array(hashes, np.uint64)
        for i, k in enumerate(full):
            own = h[at[i] : at[i + 1]]
            ones = np.zeros(64, np.int64)
            for j in range(0, len(own), 1 << 16):
                ones += np.unpackbits(own[j : j + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[k] = np.packbits(2 * ones > len(own), bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp as a signed long."""
    bound_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints_of(text_bytes(batch.column(1)), width).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def n_blocks(n: int, distance: int = DISTANCE) -> int:
    """Blocks such that a bucket of random fingerprints holds a few of n at most."""
    b = distance + 2
    while b < 12 and 64 * (b - distance) // b < np.log2(max(2, n)) - 2:
        b += 1
    return b


def _masks(blocks: int, distance: int) -> list[np.uint64]:
    """A mask for each choice of blocks that a pair within the distance may agree in."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    one = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [np.uint64(sum(one[k] for k in own)) for own in combinations(range(blocks), blocks - distance)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _table(fp: np.ndarray) -> np.ndarray:
    """Distances to the pivots, a row for each fingerprint."""
    return np.bitwise_count(fp[:, None] ^ _PIVOT[None, :]).astype(np.int8)


def link_buckets(key: np.ndarray, fp: np.ndarray, rep: np.ndarray, distance: int = DISTANCE) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges between linked rows of equal keys; key is sorted. Large buckets give spanning edges only."""
    if len(key) < 2:
        return []
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(key)])))
    out = []
    member = np.repeat(sizes, sizes)
    small = np.flatnonzero((member > 1) & (member <= SMALL))
    if len(small):
        k, f, r = key[small], fp[small], rep[small]
        table = _table(f)
        for d in range(1, int(member[small].max())):
            i = np.flatnonzero(k[d:] == k[:-d])
            if not len(i):
                break
            i = i[np.abs(table[i] - table[i + d]).max(axis=1) <= distance]
            i = i[np.bitwise_count(f[i] ^ f[i + d]) <= distance]
            if len(i):
                out.append((r[i], r[i + d]))
    for g in np.flatnonzero(sizes > SMALL):
        own = slice(starts[g], starts[g] + sizes[g])
        out += _span(fp[own], rep[own], distance)
    return out


def _span(fp: np.ndarray, rep: np.ndarray, distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that span the linked groups of one large bucket."""
    table = _table(fp)
    left = np.arange(len(fp))
    out = []
    while len(left):
        queue = [left[0]]
        left = left[1:]
        while queue and len(left):
            x = queue.pop()
            near = left[np.abs(table[left, 0] - table[x, 0]) <= distance]
            near = near[np.abs(table[near] - table[x]).max(axis=1) <= distance]
            near = near[np.bitwise_count(fp[near] ^ fp[x]) <= distance]
            if len(near):
                out.append((np.full(len(near), rep[x]), rep[near]))
                queue += near.tolist()
                left = np.setdiff1d(left, near, assume_unique=True)
    return out


def links(distinct: DataFrame, n: int, distance: int = DISTANCE) -> DataFrame:
    """(u, v): edges between the representatives of linked fingerprints. distinct has fp and rep, n rows."""
    masks = _masks(n_blocks(n, distance), distance)

    def spread(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for t, mask in enumerate(masks):
                key = _mixed((fp & mask) ^ np.uint64(t * 0x9E3779B97F4A7C15 % (1 << 64)))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0), batch.column(1)], names=["key", "fp", "rep"])

    def meet(batches):
        rest = None
        for batch in _and_end(batches):
            got = [] if batch is None else [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols = rest if batch is None else got if rest is None else [np.concatenate(x) for x in zip(rest, got, strict=True)]
            if cols is None or not len(cols[0]):
                continue
            end = len(cols[0]) if batch is None else int(np.searchsorted(cols[0], cols[0][-1]))  # the last bucket may go on
            rest = [c[end:] for c in cols]
            key, fp, rep = (c[:end] for c in cols)
            for u, v in link_buckets(key, fp.view(np.uint64), rep, distance):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    spread_out = distinct.select("fp", "rep").mapInArrow(spread, "key long, fp long, rep long")
    met = spread_out.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "u long, v long")
    return met.distinct()


def _and_end(batches):
    yield from batches
    yield None


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, width: int = SHINGLE) -> DataFrame:
    """One row per document: fingerprint (hex) and the smallest doc_id reachable over links."""
    prints = cut(fingerprints(docs, width), "fingerprints")
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    known = distinct.where("rep IS NOT NULL")
    found = components(links(known, known.count(), distance))
    named = distinct.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, distance: int = DISTANCE, width: int = SHINGLE) -> DataFrame:
    """The document with the smallest id of each group, once, with all its columns. Documents without an id all stay."""
    firsts = near_duplicates(docs, distance, width).where("doc_id = component_id").select(F.col("doc_id").alias("first")).distinct()
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    kept = rows.join(firsts, F.col("row.doc_id").cast("long") == F.col("first"), "left_semi")
    once = Window.partitionBy(F.col("row.doc_id").cast("long")).orderBy(F.xxhash64("row.text"), "row.text")
    one = kept.withColumn("nth", F.row_number().over(once)).where("nth = 1").select("row")
    return one.unionByName(rows.where("row.doc_id IS NULL")).select("row.*")
