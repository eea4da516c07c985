"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of one Arrow batch sent to Python; bounds a worker's memory when texts are very long.
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes, so that a run of long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: the session's checkpoint folder.

    Only where none is set and the driver is the only machine (local tests) is one made; on a cluster it must be set.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + os.path.join(tempfile.gettempdir(), f"checkpoints/{uuid.uuid4().hex}")
        spark.sparkContext.setCheckpointDir(at)
        at = spark.sparkContext.getCheckpointDir()
    return at.rstrip("/")


#: Tables that cut() wrote and nothing has deleted.
_WRITTEN: set[str] = set()

#: Spark's own switch: shuffle files of a finished execution go at once, not when the driver happens to collect garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back, which ends its lineage; its shuffle files go."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    _WRITTEN.add(path)
    return out


def drop_all(spark: SparkSession) -> None:
    """Delete all that cut() wrote in this process and is still there, once results are written."""
    for path in list(_WRITTEN):
        _delete(spark, path)


def drop_cut(df: DataFrame) -> None:
    """Delete what cut() wrote, once nothing reads it any more; other tables stay."""
    path = getattr(df, "_written", None)
    if path:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    if path in _WRITTEN:
        _WRITTEN.remove(path)
        jvm = spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """A string column's values as UTF-8, without decoding them."""
    return column.cast(pa.binary()).to_pylist()
