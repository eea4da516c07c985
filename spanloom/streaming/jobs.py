"""Streams: ingestion that takes what is new and stops, and state that outlives a batch."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_files(spark: SparkSession, path: str, schema: str, per_trigger: int | None = 100, form: str = "parquet") -> DataFrame:
    """A stream of files that were not read before; per_trigger limits the rate, None takes all files that are there as one batch."""
    stream = spark.readStream.schema(schema).format(form)
    return (stream if per_trigger is None else stream.option("maxFilesPerTrigger", per_trigger)).load(path)


def run_once(stream: DataFrame, target: str, checkpoint: str, mode: str = "append", form: str = "parquet") -> None:
    """Process all that is new and stop. The checkpoint makes a repeated run do nothing twice; in complete mode the target holds the latest result."""
    out = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        out = out.format(form).option("path", target)
    else:
        out = out.foreachBatch(lambda batch, _: batch.write.mode("overwrite").format(form).save(target))
    out.start().awaitTermination()


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors share: the session's checkpoint folder. Only in local mode is one made where none is set."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = f"file://{tempfile.gettempdir()}/checkpoints"
    return at.rstrip("/")


def typed_counts(events: DataFrame, time: str = "ts", width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events per window and type, with a watermark for late ones."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, width), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")


CLOCK_OUT = "key string, place long, year int, backward boolean"
_LEAST, _FRAME = -(2**31), 10_000  # the least year; rows of an emitted frame


def _advance(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Emit every row; only rows that are not behind the clock advance it.

    A key's rows come in frames of any order, so they are sorted when all are there, as arrays of 13 bytes a row. Rows without
    a year neither are behind nor advance; those without a place come last.
    """
    clock = state.get[0] if state.exists else None
    places, years, gaps = [], [], []
    for frame in frames:
        none = frame["year"].isna().to_numpy()
        unplaced = frame["place"].isna().to_numpy()
        places.append(frame["place"].astype("Int64").fillna(0).to_numpy("int64"))
        years.append(frame["year"].astype("Int64").fillna(_LEAST).to_numpy("int32"))
        gaps.append((none | (unplaced << 1)).astype("int8"))
    place, year, gap = (np.concatenate(parts) for parts in (places, years, gaps))
    order = np.lexsort((place, gap >> 1))
    place, year, gap = place[order], year[order], gap[order]
    so_far = np.maximum.accumulate(np.concatenate([np.array([_LEAST if clock is None else clock], "int32"), year]))
    none, before = (gap & 1).astype(bool), so_far[:-1]
    said = lambda values, lost: pd.Series(pd.array(values, "Int64")).mask(pd.Series(lost))
    for lo in range(0, len(place), _FRAME):
        part = slice(lo, lo + _FRAME)
        back = (year[part] < before[part]) & ~none[part]
        yield pd.DataFrame({"key": [key[0]] * len(back), "place": said(place[part], gap[part] > 1), "year": said(year[part], none[part]), "backward": back})
    if clock is not None or not none.all():
        state.update((int(so_far[-1]),))


def clocks(rows: DataFrame) -> DataFrame:
    """rows (key, place, year) with `backward`, by a clock per key that is kept between batches; within a batch rows may come in any order, a later batch has later places."""
    return rows.groupBy("key").applyInPandasWithState(_advance, CLOCK_OUT, "year int", "append", "NoTimeout")


def carried_sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions per user that every event renews."""
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return stamped.groupBy("user_id", F.session_window("ts", gap).alias("session")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("session.start").alias("start"), F.col("session.end").alias("end"), "n")
