"""Operator 2: consistent weighted sampling fingerprints.

Terms are the runs of ``SHINGLE`` lower-cased words of the whole text (all words
as one run when there are fewer), weighted by how often they occur. Per sample
and term, r and c are gamma(2, 1) and beta uniform, all drawn from a hash of the
term; t = floor(ln(weight) / r + beta) and the term with the least
ln(c) - r * (t - beta + 1) is sampled with its t. Two texts agree in a sample with
the probability of their generalised Jaccard similarity. A fingerprint holds 16
bits of each sample.

A text is compared with its edited text and with the next document by doc_id.
Documents are dealt to blocks of doc_id (bounds from quantiles, one number per
block on the driver) and sorted there; the first document of a block also goes to
the end of the block before. So texts are shuffled once and tasks stream through
their blocks with two texts in memory.

Defined cases: null text is empty; empty texts share one fixed fingerprint,
alike to each other (1) and to nothing else (0); a single document is its own
next; rows of equal doc_id follow each other by text; null doc_ids come last;
no documents, no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import lower_words, text_of
from lodgeflow.llm.shingles import mixed, shingle_hashes

SHINGLE = 2
SAMPLES = 64
#: Terms whose draws are worked out at a time, and are kept for the edited text.
TERMS = 1024
KEPT = 32_768
#: Characters of text per block of doc_ids, and the most blocks planned.
BLOCK_CHARS = 16_000_000
MOST_BLOCKS = 20_000

_SEEDS = np.random.default_rng(977).integers(1, 1 << 32, (5, 2, SAMPLES), dtype=np.uint32) | np.uint32(1)
EMPTY = b"\xff" * (2 * SAMPLES)


def _uniform(low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """terms x SAMPLES values in (0, 1): the k-th draw from both halves of a term's hash."""
    x = low * _SEEDS[k, 0]
    x += high * _SEEDS[k, 1]
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA6B)
    x >>= np.uint32(9)
    x |= np.uint32(0x3F800000)  # a float32 in [1, 2)
    u = x.view(np.float32)
    u -= np.float32(1 - 2.0 ** -24)
    return u


def _halves(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (terms & np.uint64(0xFFFFFFFF)).astype(np.uint32), (terms >> np.uint64(32)).astype(np.uint32)


def _gamma(low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    g = _uniform(low, high, k)
    g *= _uniform(low, high, k + 1)
    return np.negative(np.log(g, out=g), out=g)


def _ranks(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """ln(c) - r * (t - beta + 1) per term and sample."""
    low, high = (x[:, None] for x in _halves(terms))
    r, beta = _gamma(low, high, 0), _uniform(low, high, 4)
    log_weight = np.log(weights).astype(np.float32)[:, None]
    beta -= np.floor(log_weight / r + beta)
    beta -= np.float32(1)
    beta *= r
    rank = _gamma(low, high, 2)
    np.log(rank, out=rank)
    rank += beta
    return rank


class Weighted:
    """Terms of a text with their weights, and the ranks once they are known.
    A text of more than ``KEPT`` terms works its ranks out piece by piece."""

    def __init__(self, text: bytes, near: tuple = ()):
        self.terms, self.weights = np.unique(shingle_hashes(lower_words(text), SHINGLE), return_counts=True)
        self.ranks = None
        if 0 < len(self.terms) <= KEPT:
            ranks, known = np.empty((len(self.terms), SAMPLES), np.float32), np.zeros(len(self.terms), bool)
            for other in near:  # equal term and weight: equal ranks
                if other.ranks is not None:
                    i = np.minimum(np.searchsorted(other.terms, self.terms), len(other.terms) - 1)
                    same = ~known & (other.terms[i] == self.terms) & (other.weights[i] == self.weights)
                    ranks[same] = other.ranks[i[same]]
                    known |= same
            if not known.all():
                ranks[~known] = _ranks(self.terms[~known], self.weights[~known])
            self.ranks = ranks

    def fingerprint(self) -> bytes:
        """Two bytes per sample."""
        if not len(self.terms):
            return EMPTY
        if self.ranks is not None:
            i = self.ranks.argmin(axis=0)
        else:
            best, i = np.full(SAMPLES, np.inf, np.float32), np.zeros(SAMPLES, np.int64)
            for at in range(0, len(self.terms), TERMS):
                ranks = _ranks(self.terms[at:at + TERMS], self.weights[at:at + TERMS])
                j = ranks.argmin(axis=0)
                least = ranks[j, np.arange(SAMPLES)]
                i = np.where(least < best, at + j, i)
                best = np.minimum(best, least)
        low, high = _halves(self.terms[i])  # t of the sampled terms
        t = np.floor(np.log(self.weights[i]).astype(np.float32) / _gamma(low, high, 0) + _uniform(low, high, 4))
        sample = self.terms[i] ^ t.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        bits = (mixed(sample) >> np.uint64(48)).astype("<u2")
        bits[bits == 0xFFFF] = 0  # kept for the empty text
        return bits.tobytes()


def fingerprint(text: bytes) -> bytes:
    return Weighted(text).fingerprint()


def likeness(a: bytes, b: bytes) -> float:
    return float((np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")).mean())


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _bounds(docs: DataFrame) -> np.ndarray:
    """Upper bounds of all blocks but the last: quantiles of doc_id, at most ``MOST_BLOCKS`` numbers."""
    total, low = docs.agg(F.sum(F.length("text")), F.min("doc_id")).first()
    n = int(min(MOST_BLOCKS, max(1, -(-(total or 0) // BLOCK_CHARS))))
    bounds = np.empty(0, np.int64)
    if n > 1 and low is not None:
        at = [i / n for i in range(1, n)]
        found = docs.agg(F.percentile_approx("doc_id", at, 20 * n)).first()[0]
        bounds = np.unique(np.array(found, np.int64))
    return bounds


def _with_blocks(docs: DataFrame, bounds: np.ndarray) -> DataFrame:
    @F.pandas_udf("int")
    def block_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.full(len(ids), len(bounds), np.int32)  # nulls are last
        out[known] = np.searchsorted(bounds, ids[known].to_numpy().astype(np.int64), side="left")
        return pd.Series(out)

    return docs.withColumn("block", block_of("doc_id"))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    placed = _with_blocks(rows, _bounds(rows))
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id")
    firsts = placed.groupBy("block").agg(F.min(key).alias("first")).orderBy("block").collect()  # one row per block
    first = {r["block"]: r["first"]["doc_id"] for r in firsts}
    # a block's first document also closes the block before it, in a circle
    before = {r["block"]: firsts[i - 1]["block"] for i, r in enumerate(firsts)}

    @F.pandas_udf("array<int>")
    def sent_to(blocks: pd.Series, ids: pd.Series) -> pd.Series:
        def places(block, i):
            same = first[block] == i or (first[block] is None and pd.isna(i))
            return [2 * block, 2 * before[block] + 1] if same else [2 * block]

        return pd.Series([places(b, i) for b, i in zip(blocks, ids)])

    sent = placed.select("doc_id", "text", F.explode(sent_to("block", "doc_id")).alias("place"))
    dealt = (sent.withColumn("block", F.floor(F.col("place") / 2).cast("int")).repartition("block")
             .sortWithinPartitions("place", F.col("doc_id").asc_nulls_last(), "text"))
    return dealt.select("place", "doc_id", "text").mapInArrow(_stream, _SCHEMA)


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _pair(doc_id, text: str, own: Weighted, mark: bytes, following: str, successor: Weighted, next_mark: bytes) -> tuple:
    changed = edited(text, following)
    data = changed.encode("utf-8")
    edited_mark = mark if changed == text else Weighted(data, (own, successor)).fingerprint()
    return (doc_id, len(text), hashlib.sha256(data).hexdigest(), mark.hex(), edited_mark.hex(),
            likeness(mark, edited_mark), likeness(mark, next_mark))


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of whole blocks; a block's rows end with copies (tail) of its successor."""
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    held = None  # block, doc_id, text, terms, fingerprint of the row that waits for its next
    for batch in batches:
        out = []
        for place, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("place", "doc_id", "text")]):
            block, tail = divmod(place, 2)
            if held is None and tail:
                continue  # a further row of the successor's first doc_id
            terms = Weighted(text.encode("utf-8"))
            mark = terms.fingerprint()
            if held is not None:
                if held[0] != block:
                    raise ValueError("a block ended without the document that follows it")
                out.append(_pair(*held[1:], text, terms, mark))
            held = None if tail else (block, doc_id, text, terms, mark)
        columns = list(zip(*out)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names)
    if held is not None:
        raise ValueError("a block ended without the document that follows it")
