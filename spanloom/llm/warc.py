"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Writing: payloads of at least MIN_REVISIT bytes that are equal share one response record, that of the largest page_id; the
others are revisit records without the payload. Records are put together up to ARCHIVE_BYTES, and Spark's text writer writes each such
row as an archive, so none is larger than that and one record.

Reading: a task looks at one archive and emits every place that looks like the start of a record, with the offset of
its successor by the record's own length, without knowing which are real. Pointer jumping from offset 0
then keeps the places that a chain of records reaches, so that a record header inside a payload is rejected.

Defined cases: a null or empty page is a response of 0 bytes; a null url has no target header; line breaks in a url become spaces. A page_id
that occurs in several rows has a record for each; rows with the same payload and that same largest id are all
responses. A record cut off by the archive's end, or whose payload does not have its digest, is marked not ok by `read` and stops
`round_trip` with an error. An empty table gives no archive and no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, cut, drop_cut, shared_dir, text_bytes
from .jumping import reach

MIN_REVISIT = 1000
ARCHIVE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
#: Groups of equal payloads up to this many are sent to every executor (under 60 MB); more are joined by shuffle.
MAX_BROADCAST_GROUPS = 1_000_000

SEPARATOR = "\r\n\r\n"
CANDIDATES = "scope string, at long, to long, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, ok boolean"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def typed(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """pages as page_id, url, html (not null), digest, n_bytes and refers_to (null for responses)."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    own = own.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("n_bytes", F.octet_length("html").cast("long"))
    shared = own.where(F.col("n_bytes") >= min_revisit).groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    if shared.limit(MAX_BROADCAST_GROUPS + 1).count() <= MAX_BROADCAST_GROUPS:
        shared = F.broadcast(shared)
    refers = F.when((F.col("n_bytes") >= min_revisit) & (F.col("first") != F.col("page_id")), F.col("first"))
    return own.join(shared, "digest", "left").withColumn("refers_to", refers).drop("first")


def record(row: DataFrame | None = None) -> Column:
    """The record of a typed() row, without the separator after it."""
    header = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    page_uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    block = F.concat(F.lit(_HTTP), F.when(revisit, F.lit("")).otherwise(F.col("html")))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", page_uri(F.col("page_id"))),
        header("WARC-Date", F.lit(DATE)),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(header("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", " "))),
        F.when(revisit, F.concat(header("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), header("WARC-Refers-To", page_uri(F.col("refers_to"))))).otherwise(F.lit("")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        header("X-Payload-Length", F.col("n_bytes").cast("string")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )


def _together(most: int):
    """Rows of records with separators between them, of `most` bytes or one record."""

    def run(batches):
        held, size = [], 0
        end = SEPARATOR.encode()
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                if held and size + len(text) > most:
                    yield pa.RecordBatch.from_arrays([pa.array([end.join(held)], pa.binary()).cast(pa.string())], names=["record"])
                    held, size = [], 0
                held.append(text)
                size += len(text) + len(end)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([end.join(held)], pa.binary()).cast(pa.string())], names=["record"])

    return run


def write(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write pages as archives below path; a page is never split."""
    bound_batches(pages.sparkSession)
    rows = typed(pages).select(record().alias("record")).mapInArrow(_together(archive_bytes), "record string")
    rows.write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 1).text(path)


_FIELD = re.compile(rb"([^\r\n:]+):[ \t]*([^\r\n]*)\r\n")


def _uri_id(value: bytes | None) -> int | None:
    m = re.fullmatch(rb"<urn:page:(-?\d+)>", value or b"")
    return int(m[1]) if m else None


def places(data: bytes):
    """Each place that looks like a record: offset, successor, fields, and where the block lies."""
    at = data.find(b"WARC/1.1\r\n")
    while at >= 0:
        end = data.find(b"\r\n\r\n", at)
        fields = {k.lower(): v for k, v in _FIELD.findall(data, at + 10, end + 2)} if end >= 0 else {}
        size = fields.get(b"content-length", b"")
        if size.isdigit():
            yield at, end + 4 + int(size) + 4, fields, end + 4, end + 4 + int(size)
        at = data.find(b"WARC/1.1\r\n", at + 1)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """One row per place that looks like a record in any archive below path."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                name, data = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                rows = []
                for at, to, f, start, stop in places(data):
                    kind = f.get(b"warc-type", b"").decode("latin-1")
                    head = data.find(b"\r\n\r\n", start, stop)
                    payload = data[head + 4 : stop] if head >= 0 else b""
                    said = f.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode("latin-1")
                    size = f.get(b"x-payload-length", b"")
                    full = kind == "revisit"
                    found = said if full else hashlib.sha1(payload).hexdigest()
                    rows.append((name, at, to, _uri_id(f.get(b"warc-record-id")), kind, _uri_id(f.get(b"warc-refers-to")), int(size) if full and size.isdigit() else len(payload), found, to <= len(data) and (full or found == said)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()))],
                    names=[c.split()[0] for c in CANDIDATES.split(", ")],
                )

    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 * ARCHIVE_BYTES))
    return files.mapInArrow(run, CANDIDATES)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The archives' records that a chain from the file's start reaches."""
    found = cut(candidates(spark, path), "warc-candidates")
    longest = found.groupBy("scope").count().agg(F.max("count")).first()[0] or 0
    pointers = found.join(found.select("scope", F.col("at").alias("to")), ["scope", "to"], "left_semi")
    starts = found.where("at = 0").select("scope", F.lit(0).alias("origin"), "at")
    return found.join(reach(starts, pointers, longest).select("scope", "at"), ["scope", "at"], "left_semi")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages as archives into the shared folder, read them back, and give a row per record."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, path)
    bad = F.raise_error(F.concat(F.lit("record at "), F.col("at").cast("string"), F.lit(" of "), F.col("scope"), F.lit(" does not have its digest")))
    digest = F.when(F.col("ok"), F.col("payload_digest")).otherwise(bad)
    return read(spark, path).select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")
