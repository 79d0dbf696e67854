"""Operator 1: WARC archives with revisit resolution.

Record heads (page, payload digest) are reduced to the smallest page_id per
digest; pages join these originals on (digest, salt), so a payload that a third
of all pages share is spread over ``SALTS`` keys. Each page becomes one WARC/1.1
record, a ``response`` with its payload or a ``revisit`` that only refers to the
original, compressed as a gzip member of its own. A task joins members to files of
about ``FILE_BYTES``, and Spark's text sink writes a file per row: its line separator is
an empty gzip member, and tasks commit their files as for any table, so lost
executors leave no half archives. ``read_archives`` takes a file (bounded in bytes) per
row, parses it record by record and verifies every payload against its digest.

Defined cases: null html is an empty payload; payloads under ``MIN_BYTES`` are
always responses; a row with null page_id is never an original (it revisits one
if there is one, else it is a response); repeated rows of the original's page_id
are responses too; null urls leave their header out; line breaks in urls are
percent-encoded; no pages give an empty archive.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.llm.common import scratch_path, text_of

MIN_BYTES = 100
SALTS = 16
#: Compressed bytes of an archive file; a longer record has a file of its own.
FILE_BYTES = 32 << 20
LEVEL = 6
CRLF = "\r\n"
END = CRLF + CRLF
NOTHING = gzip.compress(b"", mtime=0)  # an empty member closes a file
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, record_id string")


def _record_id(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("")), digest))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4),
                                                     part(21, 12)), F.lit(">"))


def resolve(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Pages with payload_bytes, payload_digest and, for revisits, the
    original's page_id and url."""
    html = text_of("html")
    rows = pages.select(
        "page_id", F.regexp_replace("url", "[\r\n]", "%0A").alias("url"), html.alias("payload"),
        F.octet_length(html).cast("long").alias("payload_bytes"), F.sha2(html, 256).alias("payload_digest"))
    heads = rows.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest").agg(
        F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("original"),
        F.count(F.lit(1)).alias("n"))
    originals = heads.filter("n > 1 AND original IS NOT NULL").select(
        "payload_digest", F.col("original.page_id").alias("original_id"),
        F.col("original.url").alias("original_url"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = rows.join(originals, ["payload_digest", "salt"], "left").drop("salt")
    revisits = F.col("original_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original_id"))
    return joined.withColumn("record_type", F.when(revisits, "revisit").otherwise("response"))


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(name + ": "), value.cast("string"), F.lit(CRLF))
                  ).otherwise("")


def records(resolved: DataFrame, date: str) -> DataFrame:
    """One column ``value``: the record's text without its closing blank lines."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
                    _header("Content-Length", F.col("payload_bytes")), F.lit(CRLF))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    return resolved.select(F.concat(
        F.lit("WARC/1.1" + CRLF),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(
            _header("WARC-Profile", F.lit(REVISIT_PROFILE)),
            _header("WARC-Refers-To", _record_id(F.col("original_id"), F.col("payload_digest"))),
            _header("WARC-Refers-To-Target-URI", F.col("original_url")),
            _header("WARC-Refers-To-Date", F.lit(date)),
            _header("X-Refers-To-Page", F.col("original_id")))).otherwise(""),
        _header("X-Page", F.col("page_id")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block)),
        F.lit(CRLF), block).alias("value"))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z",
                   min_bytes: int = MIN_BYTES, file_bytes: int = FILE_BYTES) -> str:
    """Write gzip-compressed archives below ``path``, a member per record."""
    size = file_bytes

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, used = [], 0
        for batch in batches:
            for record in batch.column("value"):
                member = gzip.compress(record.as_py() + END.encode(), LEVEL, mtime=0)
                if held and used + len(member) > size:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])
                    held, used = [], 0
                held.append(member)
                used += len(member)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

    files = records(resolve(pages, min_bytes), date).select(F.col("value").cast("binary").alias("value"))
    (files.mapInArrow(join, "value binary").select(F.col("value").cast("string").alias("value")).write
     .option("lineSep", NOTHING.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1)
     .text(path))
    return path


def _parse(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) per record of a file's bytes; holds one record and 1 MB of what is
    unpacked at a time."""
    buffer, at, unzip = bytearray(), 0, zlib.decompressobj(wbits=31)
    end = END.encode()

    def more() -> bool:
        nonlocal at, unzip
        while True:
            if unzip.eof:  # a file may hold several gzip members
                at -= len(unzip.unused_data)
                unzip = zlib.decompressobj(wbits=31)
            piece = unzip.unconsumed_tail
            if not piece:
                piece = content[at:at + (1 << 18)]
                at += len(piece)
            if not piece:
                return False
            if got := unzip.decompress(piece, 1 << 20):
                buffer.extend(got)
                return True

    while True:
        while (cut := buffer.find(end)) < 0:
            if not more():
                if buffer.strip():
                    raise ValueError("archive ends inside a record head")
                return
        lines = bytes(buffer[:cut]).decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/1."):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        head = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        size = int(head["Content-Length"])
        while len(buffer) < cut + 4 + size + 4:
            if not more():
                raise ValueError("archive ends inside a record")
        block = bytes(buffer[cut + 4:cut + 4 + size])
        if buffer[cut + 4 + size:cut + 8 + size] != end:
            raise ValueError("record is not closed by two line ends")
        del buffer[:cut + 8 + size]
        yield head, block


def _row(head: dict, block: bytes) -> tuple:
    http, _, payload = block.partition(END.encode())
    fields = dict(line.split(": ", 1) for line in http.decode("utf-8").split(CRLF)[1:])
    size, digest = int(fields["Content-Length"]), head["WARC-Payload-Digest"].removeprefix("sha256:")
    if head["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
    number = lambda name: int(head[name]) if name in head else None
    return (number("X-Page"), head.get("WARC-Target-URI"), size, digest, head["WARC-Type"],
            number("X-Refers-To-Page"), head["WARC-Record-ID"])


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    rows: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        for content in batch.column(0):
            for head, block in _parse(content.as_py()):
                rows.append(_row(head, block))
                if len(rows) >= 5000:
                    yield flush()
                    rows.clear()
    yield flush()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(_read_batches, SCHEMA)


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the archives, read them back; one row per page."""
    spark = pages.sparkSession
    return read_archives(spark, write_archives(pages, path or scratch_path(spark, "warc")))
