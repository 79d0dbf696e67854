"""Operator 7: line deduplication by a deletion-neighbourhood join.

Lines are compared as lower-cased words; the edit bound is one word inserted, deleted
or replaced that is at most a fifth of the shorter line (so lines under ``NEAR_WORDS``
go by equality: any two lines of one word are one replacement apart). Every line with
a word is compared; only lines without one stay as they are. Of equal lines the earliest (by doc_id, then
line number) stays; a line within the bound of an earlier one goes as well.

1. Lines are hashed; equal lines are reduced to their earliest place.
2. Two lines within one edit share their first or last half (by the longer one's
   word count), so only lines that share such a half with another can match.
   This keeps all links and spares most lines the next step.
3. Those lines emit every variant with one word deleted, as hashed keys: lines that
   share a variant with the same word place differ by a replacement, a line equal to
   another's variant by an insertion. Least places per key are aggregated and joined
   back, so a key with a third of all lines costs one row per line, not pairs.
4. The word edit distance of each line to its earliest neighbour is verified.
5. Documents lose the lines that go; only their line numbers are joined.

Defined cases: null text is empty and stays null; blank lines stay; rows equal in
doc_id and text are decided alike; a null doc_id comes last; no documents, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import stored, text_of
from lodgeflow.llm.shingles import mixed, word_hashes

LEAST_WORDS = 1
NEAR_WORDS = 5  # one word is at most a fifth of the shorter line
SALTS = 8

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOW64 = (1 << 64) - 1


_PLACE = "last boolean, doc_id long, text_hash long"


def line_words(line: bytes) -> list[bytes]:
    """Words of a lower-cased line."""
    return line.split()


def half_keys(words: list[bytes]) -> list[int]:
    """Keys of the first and last halves, for partners that are not longer and that
    have one word more."""
    n = len(words)
    if n < NEAR_WORDS:
        return []
    keys = []
    for longer in (n, n + 1):
        half = (longer - 1) // 2
        keys.append(xxhash.xxh3_64_intdigest(b" ".join(words[:half]), seed=2 * longer) - (1 << 63))
        keys.append(xxhash.xxh3_64_intdigest(b" ".join(words[n - half:]), seed=2 * longer + 1) - (1 << 63))
    return keys


def _lowered_lines(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split(b"\n")


def _keyed(docs: DataFrame) -> DataFrame:
    """last, doc_id, text_hash (what names a document) and text."""
    return docs.select(F.col("doc_id").isNull().alias("last"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"))


def _hashed(docs: DataFrame) -> DataFrame:
    """place (last, doc_id, text_hash, line), h, g (128 bits of the line) and half keys, per
    line with a word."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, number, h, g, halves, ends = [], [], [], [], [], [0]
            for i, text in enumerate(batch.column("text").to_pylist()):
                for k, line in enumerate(_lowered_lines(text)):
                    words = line_words(line)
                    if len(words) >= LEAST_WORDS:
                        digest = xxhash.xxh3_128_intdigest(b" ".join(words))
                        at.append(i)
                        number.append(k)
                        h.append((digest & _LOW64) - (1 << 63))
                        g.append((digest >> 64) - (1 << 63))
                        halves += half_keys(words)
                        ends.append(len(halves))
            rows = batch.select(["last", "doc_id", "text_hash"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(number, pa.int32()), pa.array(h, pa.int64()), pa.array(g, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(halves, pa.int64()))],
                ["last", "doc_id", "text_hash", "line", "h", "g", "halves"])

    found = _keyed(docs).mapInArrow(emit, _PLACE + ", line int, h long, g long, halves array<long>")
    return found.select(F.struct("last", "doc_id", "text_hash", "line").alias("place"), "h", "g", "halves")


def _texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """h, g, place and normalised text of the chosen lines; documents are joined, not lines."""
    lists = chosen.groupBy("first.last", "first.doc_id", "first.text_hash").agg(
        F.collect_list(F.struct("first.line", "h", "g")).alias("wanted"))  # a document's own lines only
    doc = lambda d: d.withColumn("k0", F.coalesce("doc_id", F.lit(0)))
    joined = doc(_keyed(docs)).join(doc(lists).drop("doc_id"), ["k0", "last", "text_hash"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, number, h, g, lines = [], [], [], [], []
            for i, (text, wanted) in enumerate(zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist())):
                own = _lowered_lines(text)
                for w in wanted:
                    at.append(i)
                    number.append(w["line"])
                    h.append(w["h"])
                    g.append(w["g"])
                    lines.append(b" ".join(line_words(own[w["line"]])))
            rows = batch.select(["last", "doc_id", "text_hash"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(number, pa.int32()), pa.array(h, pa.int64()), pa.array(g, pa.int64()),
                 pa.array(lines, pa.binary())], ["last", "doc_id", "text_hash", "place", "h", "g", "line"])

    found = joined.select("last", "doc_id", "text_hash", "text", "wanted").mapInArrow(
        cut, _PLACE + ", place int, h long, g long, line binary")
    return found.select(F.struct("last", "doc_id", "text_hash", F.col("place").alias("line")).alias("place"),
                        "h", "g", "line").dropDuplicates(["h", "g"])


def _candidates(groups: DataFrame) -> DataFrame:
    """Earliest places of lines that share a half with another line."""
    halves = groups.select("h", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).filter("lo <> hi").select("half")
    near = halves.join(stored(shared), "half").select("h").distinct()
    return groups.join(near, "h").select("h", "g", "first")


VARIANTS = "no long, key long, role string"


def variant_keys(words: list[bytes]) -> tuple[int, np.ndarray, np.ndarray]:
    """Hash of the line, of each variant with one word deleted, and of each variant
    together with the place of the deleted word."""
    w = word_hashes(words)
    n = len(w)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE, np.uint64)]), dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(w * powers[:n], dtype=np.uint64)])
    lengths = np.array([n, n - 1], np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    whole = mixed(sums[-1:] + lengths[0])
    fewer = mixed(sums[:-1] + (sums[-1] - sums[1:]) * np.uint64(_INVERSE) + lengths[1])
    placed = mixed(fewer ^ (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))
    return int(whole[0].astype(np.int64)), fewer.astype(np.int64), placed.astype(np.int64)


def _variants(lines: DataFrame) -> DataFrame:
    """Rows (no, key, role): whole, fewer (deletion variants), placed."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(no, key, role):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(no)), pa.array(np.concatenate(key)),
                 pa.array(np.concatenate(role)).dictionary_encode().cast(pa.string())], ["no", "key", "role"])

        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            held = 0
            for no, line in zip(batch.column("no").to_pylist(), batch.column("line").to_pylist()):
                whole, fewer, placed = variant_keys(line.split(b" "))
                keys = np.concatenate([[whole], fewer, placed])
                for column, value in zip(out, (np.full(len(keys), no), keys, np.repeat(
                        ["whole", "fewer", "placed"], [1, len(fewer), len(placed)]))):
                    column.append(value)
                held += len(keys)
                if held > 100_000:
                    yield batch_of(*out)
                    out, held = ([], [], []), 0
            if held:
                yield batch_of(*out)

    return lines.select("no", "line").mapInArrow(emit, VARIANTS)


def within_one(a: list, b: list) -> bool:
    """Word edit distance of at most one."""
    if abs(len(a) - len(b)) > 1:
        return False
    least = min(len(a), len(b))
    head = next((i for i in range(least) if a[i] != b[i]), least)
    tail = next((i for i in range(least - head) if a[-1 - i] != b[-1 - i]), least - head)
    return head + tail >= max(len(a), len(b)) - 1


def _near(lines: DataFrame) -> DataFrame:
    """(h, g) of lines that have an earlier line within the edit bound.

    lines: no (rises with the place), h, g, line (stored)."""
    found = _variants(lines).withColumn(
        "kind", F.when(F.col("role") == "placed", "placed").otherwise("inserted"))
    by_role = lambda r: F.min(F.when(F.col("role") == r, F.col("no"))).alias(r)
    keys = stored(found.groupBy("key", "kind").agg(
        by_role("whole"), by_role("fewer"), by_role("placed"), F.min("no").alias("lo"), F.max("no").alias("hi"))
        .filter("lo <> hi").drop("lo", "hi"))
    partner = (F.when(F.col("role") == "placed", F.col("placed")).when(F.col("role") == "whole", F.col("fewer"))
               .otherwise(F.col("whole")))
    best = (found.join(keys, ["key", "kind"]).withColumn("partner", partner).filter("partner < no")
            .groupBy("no").agg(F.min("partner").alias("partner")))
    pairs = best.join(lines.select("no", "h", "g", F.col("line").alias("mine")), "no")
    other = lines.select(F.col("no").alias("partner"), F.col("line").alias("theirs"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [within_one(a.split(b" "), b.split(b" ")) for a, b in
                    zip(batch.column("mine").to_pylist(), batch.column("theirs").to_pylist())]
            yield batch.select(["h", "g"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(other, "partner").select("h", "g", "mine", "theirs").mapInArrow(verify, "h long, g long")


def lines_to_drop(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, drop (line numbers) of documents that lose lines."""
    slim = stored(_hashed(docs))
    groups = stored(slim.groupBy("h", "g").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"),
                                               F.first("halves").alias("halves")))
    chosen = stored(_candidates(groups))
    # sorted by place, so that the number of a line tells which came first
    lines = stored(_texts(docs, chosen).orderBy("place").withColumn("no", F.monotonically_increasing_id()))
    near = stored(_near(lines))
    decided = (groups.select("h", "g", "first", "n").join(near.withColumn("near", F.lit(True)), ["h", "g"], "left")
               .filter("n > 1 OR near").select("h", "g", "first", F.coalesce("near", F.lit(False)).alias("near")))
    # a line that many documents share is dealt to SALTS tasks
    salted = decided.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dropped = (slim.select("place", "h", "g", F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int").alias("salt"))
               .join(salted, ["h", "g", "salt"]).filter("near OR place <> first"))
    return dropped.groupBy(F.col("place.doc_id").alias("doc_id"), F.col("place.last").alias("last"),
                           F.col("place.text_hash").alias("text_hash")).agg(
        F.collect_set("place.line").alias("drop"))  # a document's own lines only


def _cut(docs: DataFrame) -> DataFrame:
    """row (all columns), new text, n_lines, n_dropped per document row."""
    gone = stored(lines_to_drop(docs)).select(F.coalesce("doc_id", F.lit(0)).alias("k0"), F.col("last").alias("k1"),
                                              F.col("text_hash").alias("k2"), "drop")
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("k0"),
                       F.col("doc_id").isNull().alias("k1"), F.xxhash64(text_of()).alias("k2"))
    rows = rows.join(gone, ["k0", "k1", "k2"], "left")
    lines = F.split(F.col("row.text"), "\n")

    def without(own: Column) -> Column:
        # line numbers that stay, by hash, not by searching the list for each line
        stay = F.array_sort(F.array_except(F.transform(own, lambda x, i: i), F.col("drop")))
        return F.array_join(F.transform(stay, lambda i: F.get(own, i)), "\n")

    # the array of one element binds the lines, which a lambda would split again for each line
    kept = F.when(F.col("drop").isNull(), F.col("row.text")).otherwise(F.transform(F.array(lines), without)[0])
    return rows.select("row", kept.alias("text"), F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
                       F.coalesce(F.size("drop"), F.lit(0)).alias("n_dropped"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text (without the lines that go), n_lines, n_dropped per document row."""
    return _cut(docs.select("doc_id", "text")).select("row.doc_id", "text", "n_lines", "n_dropped")


def drop_duplicate_lines(docs: DataFrame) -> DataFrame:
    """Documents without the lines that go, with their columns (n_chars follows the
    text). A document that loses all its words goes."""
    cut = _cut(docs).filter("n_dropped = 0 OR " + r"text RLIKE '[^\\x20\\x09-\\x0D]'")
    out = cut.select("row", "text", "n_dropped")
    fields = []
    for name in docs.columns:
        column = F.col("row").getField(name)
        if name == "text":
            column = F.col("text")
        elif name == "n_chars":
            column = F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema[name].dataType)).otherwise(column)
        fields.append(column.alias(name))
    return out.select(*fields)
