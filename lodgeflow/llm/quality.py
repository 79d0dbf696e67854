"""Operator 4: quality classifier, histogram gradient-boosted trees.

Statistics of whole texts feed depth-limited trees that are fitted in numpy on a
bounded sample of labelled rows (``SAMPLE`` documents, the smallest md5 of
doc_id), binned to ``BINS`` quantiles. Trees are perfect binary trees flattened into
three arrays, so scoring a batch is ``DEPTH`` vectorised steps over all trees.
Only statistics of the text are inputs.

Defined cases: null and empty texts have all-zero statistics and get a score;
null labels do not teach; several labels of one doc_id teach their mean; a null
doc_id is not held out and never taught; without labels of both classes every
score is the share of ones (0.5 without any); no documents give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import split_words, text_of

#: Labelled rows that are fitted at most.
SAMPLE = 20_000
BINS = 64
DEPTH = 5
TREES = 120
RATE = 0.1
FOLDS = 5
CUT = 0.3

FEATURES = ["log_words", "log_lines", "word_chars", "words_per_line", "distinct_words", "top_word",
            "repeated_next", "distinct_pairs", "dup_lines", "upper", "digit", "stop_marks", "exclaim", "pipe",
            "symbols", "other_marks", "non_ascii", "long_words", "capital_words", "marked_words"]

_KIND = np.zeros(256, np.int64)
for _kind, _chars in enumerate([b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"|",
                                b"#*$%&<>^~=+_@\\{}[]", b"\"'()/-`"], 1):
    _KIND[list(_chars)] = _kind
_KIND[128:192] = 9  # bytes inside a code point
_KIND[192:] = 8


def statistics(text: str) -> list[float]:
    """One value per name in ``FEATURES``."""
    words = split_words(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_KIND[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)], minlength=10)
    chars = len(text)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, words))
    pairs = set(zip(words, words[1:]))
    return [
        float(np.log1p(n)), float(np.log1p(len(lines))), letters / n, n / max(1, len(lines)),
        len(counts) / n, max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n, len(pairs) / max(1, n - 1),
        1 - len(set(lines)) / max(1, len(lines)),
        kinds[1] / chars, kinds[2] / chars, kinds[3] / n, kinds[4] / n, kinds[5] / n, kinds[6] / n, kinds[7] / n,
        kinds[8] / chars, sum(c for w, c in counts.items() if len(w) > 12) / n,
        sum(c for w, c in counts.items() if w[0].isupper()) / n,
        sum(c for w, c in counts.items() if not w[-1].isalnum()) / n,
    ]


@dataclass
class Trees:
    """Flattened perfect trees: nodes of a tree in level order, then its leaves."""

    feature: np.ndarray  # trees x (2^depth - 1)
    limit: np.ndarray  # same; go right when the value is above it
    leaf: np.ndarray  # trees x 2^depth
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        total = np.full(len(x), self.prior)
        if trees and len(x):
            tree, row = np.arange(trees)[None, :], np.arange(len(x))[:, None]
            node = np.zeros((len(x), trees), np.int64)
            while node[0, 0] < inner:  # all paths have one length
                node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.limit[tree, node])
            total = total + self.leaf[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boosts logistic loss; every split is found on histograms of binned values."""
    inner, width = 2 ** depth - 1, x.shape[1]
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    prior = float(np.log(mean / (1 - mean)))
    empty = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), prior)
    if not len(y) or y.min() == y.max():
        return empty
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    flat = binned + np.arange(width) * BINS
    raw = np.full(len(y), prior)
    features, limits, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        feature, limit, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, many = 2 ** level - 1, 2 ** level
            cell = ((node - first)[:, None] * (width * BINS) + flat).ravel()
            size = many * width * BINS
            shape = (many, width, BINS)
            gl = np.bincount(cell, np.repeat(g, width), size).reshape(shape).cumsum(axis=2)
            hl = np.bincount(cell, np.repeat(h, width), size).reshape(shape).cumsum(axis=2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
            gain[(hl < 2) | (ht - hl < 2)] = 0
            best = gain.reshape(many, -1).argmax(axis=1)
            for k in range(many):
                j, b = divmod(int(best[k]), BINS)
                if gain[k, j, b] > 1e-6 and b < len(edges[j]):
                    feature[first + k], limit[first + k] = j, edges[j][b]
            at = node
            node = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > limit[at])
        slot = node - inner
        value = rate * np.bincount(slot, g, inner + 1) / (np.bincount(slot, h, inner + 1) + 1)
        raw = raw + value[slot]
        features.append(feature)
        limits.append(limit)
        leaves.append(value)
    return Trees(np.array(features), np.array(limits), np.array(leaves), prior)


def _fold(folds: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % F.lit(folds)


def _matrix(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(len(texts), len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS) -> Trees:
    """Fit on at most ``sample`` labelled documents outside the held-out fold."""
    chosen = (labels.select("doc_id", "quality").filter("doc_id IS NOT NULL AND quality IS NOT NULL")
              .filter(_fold(folds) != 0).groupBy("doc_id").agg(F.avg("quality").alias("quality"))
              .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample))
    taught = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")  # <= sample rows

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(list(x), pa.list_(pa.float64())),
                                              batch.column("quality")], ["doc_id", "x", "quality"])

    rows = (taught.mapInArrow(measure, "doc_id long, x array<double>, quality double")
            .orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample).collect())  # <= sample rows
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r["quality"] for r in rows], float))


def score(docs: DataFrame, model: Trees, cut: float = CUT) -> DataFrame:
    """All columns of ``docs`` as struct ``row``, with score and predicted."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        return held.value.score(_matrix(list(texts)))

    @F.pandas_udf("double")
    def quality_score(texts):
        import pandas as pd

        return pd.Series(run(texts), dtype="float64")

    scored = docs.select(F.struct("*").alias("row"), quality_score(text_of()).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= cut, 1).otherwise(0).cast("int"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted per document row."""
    rows = docs.select("doc_id", "text")
    return score(rows, train(rows, labels)).select(
        "row.doc_id", F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % FOLDS == 0, F.lit(False)).alias("held_out"),
        "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents the classifier accepts, with their columns."""
    return score(docs, train(docs, labels)).filter("predicted = 1").select("row.*")
