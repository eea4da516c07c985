"""Multi-string Burrows-Wheeler transforms of shards, merged by iterative interleave refinement.

All arrays are numpy; symbols are byte + 1, and each string ends with symbol 0.
"""

from __future__ import annotations

import numpy as np


class Shard:
    """The transform of some strings: `symbol[r]` precedes row r's suffix, which starts at `start[r]`; `back[r]` is the row of the suffix one symbol longer (LF mapping)."""

    def __init__(self, text: np.ndarray, ends: np.ndarray):
        """text: symbols with ends[i] the place of string i's final 0."""
        n = len(text)
        before = np.arange(-1, n - 1)
        starts = np.concatenate(([0], ends[:-1] + 1))
        before[starts] = ends  # a whole string is preceded by its own end
        self.start = _suffix_order(text, ends)
        row = np.empty(n, np.int64)
        row[self.start] = np.arange(n)
        self.symbol = text[before[self.start]]
        self.back = row[before[self.start]]


def _suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, each reaching to its string's end, by prefix doubling."""
    n = len(text)
    longest = int(np.diff(np.concatenate(([-1], ends))).max())
    left = np.repeat(ends, np.diff(np.concatenate(([-1], ends)))) - np.arange(n)  # symbols before the string's end
    rank = text.astype(np.int64)
    size = 1
    while size <= longest:
        further = np.zeros(n, np.int64)
        inside = np.flatnonzero(left >= size)
        further[inside] = rank[inside + size] + 1
        both = rank * (n + 259) + further
        order = np.argsort(both, kind="stable")
        sorted_ = both[order]
        new = np.concatenate(([0], np.cumsum(sorted_[1:] != sorted_[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            break
        size *= 2
    return np.argsort(rank, kind="stable")


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interleave the shards' rows until suffixes are in order of their first `depth` symbols.

    Step h takes the order by h - 1 symbols, maps each row to the suffix one symbol longer, and deals the
    rows stably into that symbol's bucket; suffixes are never compared or sorted again. Where the symbol or
    the block of h - 1 changes, a block ends, so that neighbours there share exactly h - 1 symbols. A block
    of one row stays alone when it is extended, so only rows of larger blocks go on.

    Returns (shard, row, block) of the rows whose `depth`-symbol prefix is repeated, in order; rows of a
    block are a repeated interval (common prefix of at least `depth`).
    """
    base = np.cumsum([0, *(len(s.symbol) for s in shards)])
    symbol = np.concatenate([s.symbol for s in shards])
    back = np.concatenate([s.back + b for s, b in zip(shards, base, strict=False)])
    row = np.arange(len(symbol))
    block = np.zeros(len(symbol), np.int64)
    for _ in range(depth):
        if not len(row):
            break
        c = symbol[row]
        deal = np.argsort(c, kind="stable")  # a counting sort by symbol
        c, row, block = c[deal], back[row][deal], block[deal]
        begins = np.concatenate(([True], (c[1:] != c[:-1]) | (block[1:] != block[:-1])))
        number = np.cumsum(begins) - 1
        alone = begins & np.concatenate((begins[1:], [True]))
        row, block = row[~alone], number[~alone]
    shard = np.searchsorted(base, row, side="right") - 1
    return shard, row - base[shard], block


def repeated_in_smaller(strings: list[bytes], owners: np.ndarray, length: int, shard_symbols: int = 1 << 18) -> list[np.ndarray]:
    """For each string, at each place, whether the `length` bytes from there occur in a string of a smaller owner."""
    sizes = np.array([len(s) for s in strings], np.int64)
    marks = [np.zeros(max(0, n - length + 1), bool) for n in sizes]
    shards, firsts, begin, symbols = [], [], 0, 0
    spans = []
    for i in range(len(strings)):
        symbols += sizes[i] + 1
        if symbols >= shard_symbols or i == len(strings) - 1:
            spans.append((begin, i + 1))
            begin, symbols = i + 1, 0
    for a, b in spans:
        ends = np.cumsum(sizes[a:b] + 1) - 1
        text = np.zeros(int(ends[-1]) + 1, np.uint16)
        keep = np.ones(len(text), bool)
        keep[ends] = False
        text[keep] = np.frombuffer(b"".join(strings[a:b]), np.uint8).astype(np.uint16) + 1
        shards.append(Shard(text, ends))
        firsts.append(ends)
    shard, row, block = merge(shards, length)
    if not len(row):
        return marks
    string, offset = np.empty(len(row), np.int64), np.empty(len(row), np.int64)
    for k, (a, _) in enumerate(spans):
        own = np.flatnonzero(shard == k)
        at = shards[k].start[row[own]]
        local = np.searchsorted(firsts[k], at)
        string[own] = a + local
        offset[own] = at - np.where(local > 0, firsts[k][np.maximum(local - 1, 0)] + 1, 0)
    whole = np.flatnonzero(offset + length <= sizes[string])
    string, offset, block = string[whole], offset[whole], block[whole]
    if not len(block):
        return marks
    begins = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    least = np.minimum.reduceat(owners[string], begins)
    least = np.repeat(least, np.diff(np.concatenate((begins, [len(block)]))))
    hit = owners[string] > least
    for s, o in zip(string[hit].tolist(), offset[hit].tolist(), strict=True):
        marks[s][o] = True
    return marks
