"""Operator 12: token ids as length-delimited binary records with a separate offset index.

A record is the length of its payload (8 bytes, little-endian), the masked CRC-32C of that
length, the payload, and the masked CRC-32C of the payload, which is the framing that
TFRecord readers know. The payload is a 24-byte head (flags, number of ids, doc_id, number
of the record in its file) and the ids, two bytes each where the vocabulary allows, else
four. A file ends with a record of length 0.

1. Documents are range-partitioned by doc_id and sorted, so that files in the order of
   their names hold the corpus in ascending order; equal doc_ids may span partitions.
2. A task tokenises its documents, frames them and gives a row per file of about
   ``FILE_BYTES``; Spark's text sink writes that row as it is, and the record of length 0
   is its line separator. So files reach any store that Spark writes to.
3. Reading takes a file (bounded in bytes) per row, follows the lengths and verifies both
   checksums of every record; anything wrong raises an error that names file and offset.
4. The index is a Parquet table made from the files: a row per record with file, offset,
   length, doc_id, number of ids and how many ids all files hold before it.
   ``read_shuffled`` puts the index in a random order and seeks the records one by one.

Defined cases: a null or empty text is the end id alone; a null doc_id is carried through
(a flag) and comes last; rows with one doc_id follow each other in the order of the table;
a document longer than ``FILE_BYTES`` has a file of its own; no documents, no records;
further columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodgeflow.llm.checksums import crc32c, masked
from lodgeflow.llm.common import stored, text_of, with_row_number
from lodgeflow.llm.tokens import encoder, parts, vocabulary_size

END_ID = 1
FILE_BYTES = 32 << 20
FRAME, HEAD, TAIL = struct.Struct("<QI"), struct.Struct("<IIqQ"), struct.Struct("<I")
NO_DOC_ID, WIDE_IDS = 1, 2  # flags


def _mask_of(data: bytes) -> int:
    """Masked CRC-32C of at least four bytes."""
    return int(masked(crc32c(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)])))[0])


#: The record of length 0; the CRC-32C of nothing is 0.
LAST = FRAME.pack(0, _mask_of(bytes(8))) + TAIL.pack(int(masked(np.zeros(1, np.uint32))[0]))


def frame(doc_ids: list, first: int, ids: np.ndarray, begins: np.ndarray, wide: bool) -> list[bytes]:
    """Records of documents whose ids are ids[begins[i]:begins[i + 1]]; ``first`` numbers them."""
    width = np.dtype("<u4" if wide else "<u2")
    ids = ids.astype(width)
    payloads = []
    for i, doc_id in enumerate(doc_ids):
        own = ids[begins[i]:begins[i + 1]]
        flags = (NO_DOC_ID if doc_id is None else 0) | (WIDE_IDS if wide else 0)
        payloads.append(HEAD.pack(flags, len(own), doc_id or 0, first + i) + own.tobytes())
    lengths = np.array([len(p) for p in payloads], np.int64)
    starts = np.cumsum(lengths) - lengths
    body = masked(crc32c(np.frombuffer(b"".join(payloads), np.uint8), starts, lengths)).tolist()
    sizes = lengths.astype("<u8").view(np.uint8)
    at = np.arange(len(lengths)) * 8
    head = masked(crc32c(sizes, at, np.full(len(lengths), 8))).tolist()
    return [FRAME.pack(n, h) + p + TAIL.pack(b) for n, h, p, b in zip(lengths.tolist(), head, payloads, body)]


def write_records(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = END_ID,
                  file_bytes: int = FILE_BYTES) -> None:
    """Files of records under ``path``/records, in ascending order of doc_id."""
    model = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    wide = max(vocabulary_size(tokenizer_json), end_id + 1) > 1 << 16

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, number, held, size = encoder(model.value), 0, [], 0

        def row():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

        for batch in chain.from_iterable(map(parts, batches)):
            ids, begins = run.encode(batch.column("text"), end_id)
            doc_ids, at = batch.column("doc_id").to_pylist(), 0
            while at < len(doc_ids):
                # as many as fill the file, one at least in a new one
                limit = begins[at] + max(0, file_bytes - size) // (4 if wide else 2)
                end = max(int(np.searchsorted(begins, limit, side="right")) - 1, at + (not held))
                records = frame(doc_ids[at:end], number, ids, begins[at:end + 1], wide)
                held += records
                size += sum(map(len, records))
                number, at = number + len(records), end
                if at < len(doc_ids):
                    yield row()
                    number, held, size = 0, [], 0
        if held:
            yield row()

    keys = (F.col("doc_id").asc_nulls_last(), F.col("row_id"))
    rows = with_row_number(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")))
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    (rows.mapInArrow(files, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", LAST.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", 1).text(f"{path}/records"))


RECORD = ("file string, offset long, length long, doc_id long, n_ids long, ids_crc32 long, before long, ids binary")


def parse(name: str, content: bytes, with_ids: bool) -> list[list]:
    """Columns of ``RECORD`` for a whole file, verified."""
    data, offsets, lengths, at = np.frombuffer(content, np.uint8), [], [], 0
    while content:  # Spark leaves an empty file where there are no documents
        if at + FRAME.size > len(content):
            raise ValueError(f"{name}: record cut short at {at}")
        length, _ = FRAME.unpack_from(content, at)
        if not length:
            break
        if length < HEAD.size or at + FRAME.size + length + TAIL.size > len(content):
            raise ValueError(f"{name}: wrong length at {at}")
        offsets.append(at)
        lengths.append(length)
        at += FRAME.size + length + TAIL.size
    if content and content[at:] != LAST:
        raise ValueError(f"{name}: the file goes on behind its last record at {at}")
    offset, length = np.array(offsets, np.int64), np.array(lengths, np.int64)
    _verify(name, data, offset, length)
    columns: list[list] = [[name] * len(offsets), offsets, lengths, [], [], [], [], []]
    before = 0
    for number, (start, size) in enumerate(zip(offsets, lengths)):
        doc_id, ids, place = payload(content[start + FRAME.size:start + FRAME.size + size])
        if place != number:
            raise ValueError(f"{name}: record {number} says it is {place}")
        for column, value in zip(columns[3:], (doc_id, len(ids), zlib.crc32(ids), before, ids.tobytes() if with_ids else None)):
            column.append(value)
        before += len(ids)
    return columns


def _verify(name: str, data: np.ndarray, offset: np.ndarray, length: np.ndarray) -> None:
    for start, size in ((offset, np.full(len(offset), 8)), (offset + FRAME.size, length)):
        kept = start + size
        found = sum(data[kept + i].astype(np.uint32) << np.uint32(8 * i) for i in range(4)) if len(kept) else kept
        wrong = np.flatnonzero(masked(crc32c(data, start, size)) != found)
        if len(wrong):
            raise ValueError(f"{name}: wrong checksum in the record at {int(offset[wrong[0]])}")


def payload(data: bytes) -> tuple[int | None, np.ndarray, int]:
    """doc_id, ids (little-endian uint32) and number in its file of a record's payload."""
    flags, n, doc_id, place = HEAD.unpack_from(data)
    ids = np.frombuffer(data, "<u4" if flags & WIDE_IDS else "<u2", n, HEAD.size).astype("<u4")
    return (None if flags & NO_DOC_ID else doc_id), ids, place


def read_records(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """A row per record (``RECORD``; ids as uint32, or null), in no order. ``before`` counts
    the ids before it in its file."""
    names = [c.split()[0] for c in RECORD.split(", ")]
    types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in RECORD.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("file"), batch.column("content")):
                columns = parse(name.as_py(), content.as_py(), with_ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").mapInArrow(read, RECORD)


def write_index(spark: SparkSession, path: str) -> DataFrame:
    """Makes ``path``/index from the files and returns it: file, offset, length, doc_id,
    start (ids of all records before it), n_ids, ids_crc32."""
    slim = stored(read_records(spark, path, with_ids=False).drop("ids"))
    # one row per file: the running sum over files is one task whatever the documents hold
    names = F.col("file")
    files = slim.groupBy("file").agg(F.sum("n_ids").alias("n")).select(
        "file", "n", F.regexp_extract(names, r"^part-(\d+)-", 1).cast("long").alias("task"),
        F.regexp_extract(names, r"-c(\d+)", 1).cast("long").alias("part"))
    earlier = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    index = slim.join(files, "file").select(
        "file", "offset", "length", "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_ids", "ids_crc32")
    index.write.parquet(f"{path}/index")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


class RecordFile:
    """Random access to an open file of records."""

    def __init__(self, file, name: str = "records"):
        self.file, self.name = file, name

    def read(self, offset: int, length: int) -> tuple[int | None, np.ndarray]:
        """doc_id and ids of the record at an offset of the index, verified."""
        self.file.seek(offset)
        data = self.file.read(FRAME.size + length + TAIL.size)
        if len(data) < FRAME.size + length + TAIL.size or FRAME.unpack_from(data)[0] != length:
            raise ValueError(f"{self.name}: no record of {length} bytes at {offset}")
        _verify(self.name, np.frombuffer(data, np.uint8), np.zeros(1, np.int64), np.array([length]))
        return payload(data[FRAME.size:FRAME.size + length])[:2]


def read_shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """doc_id, ids (uint32) of all records in a random order that ``seed`` fixes.

    Only the index is shuffled; tasks seek the records in the store, which pyarrow must
    reach (elsewhere sort ``read_records``)."""
    key = F.xxhash64(F.lit(seed), "file", "offset")
    order = read_index(spark, path).select("file", "offset", "length", key.alias("key"))
    order = order.repartitionByRange("key").sortWithinPartitions("key", "file", "offset")
    folder = f"{path}/records"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        for batch in batches:
            rows = list(zip(*[batch.column(c).to_pylist() for c in ("file", "offset", "length")]))
            out, opened = [None] * len(rows), None
            for i in sorted(range(len(rows)), key=rows.__getitem__):  # a file is opened once a batch
                name, offset, length = rows[i]
                if opened is None or opened.name != name:
                    opened = RecordFile(store.open_input_file(f"{root}/{name}"), name)
                out[i] = opened.read(offset, length)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1].tobytes() for x in out], pa.binary())],
                ["doc_id", "ids"])

    return order.select("file", "offset", "length").mapInArrow(read, "doc_id long, ids binary")


def encode_documents(docs: DataFrame, path: str, tokenizer_json: str) -> DataFrame:
    """Writes documents and index under ``path`` and returns the index, made from the files."""
    write_records(docs, path, tokenizer_json)
    return write_index(docs.sparkSession, path)
