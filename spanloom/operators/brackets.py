"""Bracketed notes inside paragraphs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

OPEN, CLOSE = "〈", "〉"
_MARK = "\\[[一二三四五六七八九十百〇○]+\\]"
_NOTE = f"注{_MARK}"
_MOST = 1 << 18  # brackets that are judged at once, unless one text has more


def _judged(rows: DataFrame, key: str, text: str, opening: str, closing: str, further: str, judge: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, ...]]) -> DataFrame:
    """(key, at, step, further columns) of what `judge` takes of the brackets, of which it sees each one's row, its place in all of them and its step.

    Each row is judged by itself, so nothing is shuffled or sorted; texts stay in Spark, and Python gets a number for each bracket:
    how far it is from the last one, negative where it closes.
    """
    one = f"(?s)[^\\Q{opening}{closing}\\E]*[\\Q{opening}{closing}\\E]"
    signed = lambda piece: F.length(piece) * F.when(F.right(piece, F.lit(1)) == opening, 1).otherwise(-1)
    schema = StructType([rows.schema[key], *StructType.fromDDL(f"at int, step int{further}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            steps, ends = pc.list_flatten(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(sizes, dtype=np.int64)
            first = 0
            while first < len(sizes):  # as many rows as hold _MOST brackets, or one
                begin = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, begin + _MOST, "right")))
                row = np.repeat(np.arange(first, last), sizes[first:last])
                moves = steps[begin : ends[last - 1]]
                so_far = np.cumsum(np.abs(moves))
                starts = ends[first:last] - sizes[first:last] - begin  # where a row's brackets begin
                at = so_far - np.repeat(np.concatenate([[0], so_far])[starts], sizes[first:last]) - 1
                step = np.sign(moves)
                taken, *more = judge(row, starts[row - first], step)
                arrays = [batch.column(0).take(pa.array(row[taken])), pa.array(at[taken].astype(np.int32)), pa.array(step[taken].astype(np.int32)), *map(pa.array, more)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)
                first = last

    return rows.select(key, F.transform(F.regexp_extract_all(text, F.lit(one), 0), signed).alias("_moves")).mapInArrow(run, schema)


def _depth(start: np.ndarray, step: np.ndarray) -> np.ndarray:
    so_far = np.cumsum(step)
    return so_far - np.concatenate([[0], so_far])[start]


def _lone(row: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Which closing brackets take their row's depth to a new minimum below 0. Rows ascend."""
    depth = _depth(start, step)
    shift = row * (2 * len(row) + 1)  # puts every depth of a row below those of the rows before
    least = np.minimum.accumulate(depth - shift) + shift
    before = np.concatenate([[0], least[:-1]])
    before[start] = 0
    return (step < 0) & (depth < np.minimum(before, 0))


def depths(rows: DataFrame, key: str, text: str = "text", opening: str = OPEN, closing: str = CLOSE) -> DataFrame:
    """One row per bracket: key, at, bracket, step (+1 or -1) and depth after it. Each row's text counts by itself."""
    every = lambda row, start, step: (slice(None), _depth(start, step))
    d = _judged(rows, key, text, opening, closing, ", depth long", every)
    return d.select(key, "at", F.when(F.col("step") > 0, opening).otherwise(closing).alias("bracket"), "step", "depth")


def orphans(rows: DataFrame, key: str, text: str = "text", opening: str = OPEN, closing: str = CLOSE) -> DataFrame:
    """(key, at, bracket) of brackets without partner.

    A closing one has none where the balance from the left falls to a new minimum below 0; an opening one where
    the balance from the right does.
    """

    def judge(row: np.ndarray, start: np.ndarray, step: np.ndarray) -> tuple[np.ndarray]:
        n = len(row)
        ends = np.searchsorted(row, row, "right")  # from the right, rows start at their ends
        right = _lone((row.max(initial=0) - row)[::-1], (n - ends)[::-1], -step[::-1])[::-1]
        return (_lone(row, start, step) | right,)

    d = _judged(rows, key, text, opening, closing, "", judge)
    return d.select(key, "at", F.when(F.col("step") > 0, opening).otherwise(closing).alias("bracket"))


def innermost_removed(text: Column, opening: str = OPEN, closing: str = CLOSE) -> Column:
    """The text without bracketed parts, at any depth; brackets without partner are ordinary characters.

    One pass with a stack: an opening bracket begins a part, a closing one drops the last part.
    """
    tokens = F.regexp_extract_all(text, F.lit(f"(?s)[\\Q{opening}{closing}\\E]|[^\\Q{opening}{closing}\\E]+"), 0)
    last = lambda parts: F.element_at(parts, -1)
    front = lambda parts: F.slice(parts, 1, F.size(parts) - 1)

    def step(parts: Column, token: Column) -> Column:
        longer = F.concat(front(parts), F.array(F.concat(last(parts), token)))
        return F.when(token == opening, F.concat(parts, F.array(F.lit("")))).when((token == closing) & (F.size(parts) > 1), front(parts)).otherwise(longer)

    return F.aggregate(tokens, F.array(F.lit("")), step, lambda parts: F.array_join(parts, opening))


def strict_notes(text: Column, opening: str = OPEN, closing: str = CLOSE) -> Column:
    """The text itself, or an error where its brackets do not balance."""
    count = lambda c: F.length(text) - F.length(F.replace(text, F.lit(c)))
    left = innermost_removed(text, opening, closing)
    lone = F.contains(left, F.lit(opening)) | F.contains(left, F.lit(closing)) | (count(opening) != count(closing))
    return F.when(lone, F.raise_error(F.concat(F.lit("brackets do not balance: "), F.substring(text, 1, 40)))).otherwise(text)


def split_notes(paragraphs: DataFrame, group: str, order: str, text: str = "text", opening: str = OPEN, closing: str = CLOSE) -> DataFrame:
    """Main text and notes of a document's paragraphs: group, para_no, main_text, notes (at, text), warning.

    A note may run over paragraphs, which are then one. Nested brackets belong to the outer note; brackets without partner
    are ordinary characters. The order of a document's paragraphs matters, so a document is one group.
    """
    types = f"{group} {paragraphs.schema[group].dataType.simpleString()}"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable")
        texts = [t or "" for t in rows[text]]
        lone, open_at = set(), []
        for p, t in enumerate(texts):
            for i, c in enumerate(t):
                if c == opening:
                    open_at.append((p, i))
                elif c == closing:
                    if open_at:
                        open_at.pop()
                    else:
                        lone.add((p, i))
        lone.update(open_at)
        main, notes, note, depth, out = [], [], [], 0, []
        for p, t in enumerate(texts):
            for i, c in enumerate(t):
                if c == opening and (p, i) not in lone:
                    depth += 1
                    if depth == 1:
                        note = []
                        continue
                elif c == closing and (p, i) not in lone:
                    depth -= 1
                    if depth == 0:
                        notes.append({"at": len(main), "text": "".join(note)})
                        continue
                (note if depth else main).append(c)
            if depth == 0:
                out.append((rows[group].iloc[0], len(out) + 1, "".join(main), notes, None))
                main, notes = [], []
        if lone and out:
            out[0] = (*out[0][:4], f"{len(lone)} brackets without partner")
        return pd.DataFrame(out, columns=[group, "para_no", "main_text", "notes", "warning"])

    return paragraphs.groupBy(group).applyInPandas(run, f"{types}, para_no int, main_text string, notes array<struct<at:int,text:string>>, warning string")


def uses_markers(paragraphs: DataFrame, group: str, text: str = "text") -> DataFrame:
    """Documents whose notes are paragraphs `注[N]` that belong to markers `[N]`."""
    t = F.col(text)
    return paragraphs.groupBy(group).agg((~F.bool_or(F.contains(t, F.lit(OPEN))) & F.bool_or(t.rlike(_NOTE))).alias("markers"))


def marker_notes(paragraphs: DataFrame, group: str, order: str, text: str = "text") -> DataFrame:
    """The k-th marker of a document's main text with its k-th note: group, order, at, note."""
    from .spans import find_all, kth_pairs

    notes = paragraphs.where(F.col(text).rlike(f"^{_NOTE}")).select(group, order, F.regexp_replace(text, f"^{_NOTE}", "").alias("note"))
    mains = paragraphs.where(~F.col(text).rlike(f"^{_NOTE}")).select(group, order, F.posexplode(find_all(F.col(text), _MARK)).alias("mark_no", "m"))
    marks = mains.select(group, F.col(order).alias("para"), "mark_no", F.col("m.at").alias("raw_at"), F.col("m.length").alias("size"))
    w = Window.partitionBy(group, "para").orderBy("mark_no").rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.withColumn("at", (F.col("raw_at") - F.coalesce(F.sum("size").over(w), F.lit(0))).cast("int"))
    return kth_pairs(marks, notes.withColumnRenamed(order, "note_para"), [group], ["para", "mark_no"], ["note_para"]).select(group, F.col("para").alias(order), "at", "note")
