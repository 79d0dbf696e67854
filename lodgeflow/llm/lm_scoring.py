"""Operator 8: scoring documents with a gated recurrent language model.

1. Words of all training documents are counted (per batch, then by shuffle).
2. The ``HOT`` most frequent words go to the tasks with their counts; every other
   word of a document is joined to its count by shuffle, so the scores are exact for
   any vocabulary.
3. The model knows the ``SYMBOLS`` most frequent words, the end, and one symbol for all
   other words, whose counts spell out which one it is:
   (c + 1) / (their tokens + their number + 1). The softmax starts from the
   counts of the whole corpus. In each of ``ROUNDS`` rounds a share of the training
   documents, chosen by the hash of doc_id and text, is dealt to shards; each shard
   trains its own copy by truncated backpropagation and the copies are averaged. There
   are as many shares as rounds, so every training document is learnt from.
4. Documents are scored whole: the state runs on from window to window.

Defined cases: null and empty texts are the end token alone; a null doc_id is not held
out; repeated rows are scored each; without training documents all counts are
zero and the model is the untrained one; no documents, no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm import recurrent
from lodgeflow.llm.common import lower_words, stored, text_of, with_row_number

FOLDS, HELD_OUT = 7, 2
HOT = 200_000
SYMBOLS = 4096
CLASSES = 64
HIDDEN = 32
ROUNDS = 2
SHARE = ROUNDS  # one document in so many trains the model in a round: all of them in the end
SHARD_TOKENS = 1_000_000
RATE = 0.004


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def count_words(docs: DataFrame) -> DataFrame:
    """word (binary), c, over whole texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                seen.update(lower_words(text))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()),
                                              pa.array(list(seen.values()), pa.int64())], ["word", "c"])

    return docs.select(text_of().alias("text")).mapInArrow(count, "word binary, c long").groupBy("word").agg(
        F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What tasks know: the hot words in descending order of count."""

    place: dict  # word -> row of the arrays
    count: np.ndarray
    tokens: int  # N
    distinct: int  # V
    ends: int
    shortlist: int  # this many hot words are symbols of their own

    @property
    def divisor(self) -> float:
        return float(self.tokens + self.distinct + 1)

    @property
    def other_tokens(self) -> int:
        return self.tokens - self.ends - int(self.count[:self.shortlist].sum())

    @property
    def other_divisor(self) -> float:
        words = self.distinct - (1 if self.ends else 0) - self.shortlist
        return float(self.other_tokens + words + 1)

    def symbol_counts(self) -> np.ndarray:
        """Shortlisted words, then the end, then the symbol for other words."""
        return np.concatenate([self.count[:self.shortlist], [self.ends, self.other_tokens]])


class _Model:
    """Symbols sorted by count, as the class layout wants them."""

    def __init__(self, words: Vocabulary, hidden: int = HIDDEN, classes: int = CLASSES):
        counts = words.symbol_counts()
        order = np.argsort(-counts, kind="stable")
        self.symbol = np.empty(len(counts), np.int64)
        self.symbol[order] = np.arange(len(counts))
        self.layout = recurrent.Layout(counts[order], classes)
        self.end, self.other = int(self.symbol[words.shortlist]), int(self.symbol[words.shortlist + 1])
        self.of_hot = np.full(len(words.count) + 1, self.other, np.int64)  # the last row is for words that are not hot
        self.of_hot[:words.shortlist] = self.symbol[:words.shortlist]
        self.of_word = dict(zip(islice(words.place, words.shortlist), self.symbol.tolist()))
        self.parameters = recurrent.start(self.layout, hidden)

    def encode(self, places: np.ndarray) -> np.ndarray:
        return np.concatenate([self.of_hot[places], [self.end]])

    def encode_words(self, words: list[bytes]) -> np.ndarray:
        """As encode of their places: the shortlist is enough to tell symbols."""
        out = np.empty(len(words) + 1, np.int64)
        out[:-1] = np.fromiter(map(self.of_word.get, words, repeat(self.other)), np.int64, len(words))
        out[-1] = self.end
        return out


def _places(known: dict, words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))


def learn_vocabulary(counts: DataFrame, documents: int, hot: int = HOT, symbols: int = SYMBOLS) -> Vocabulary:
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("c"), "word").limit(hot).toArrow()  # HOT rows at most
    return Vocabulary(dict(zip(top.column("word").to_pylist(), range(len(top)))),
                      top.column("c").to_numpy().astype(np.int64),
                      int(tokens) + documents, int(distinct) + (1 if documents else 0), documents,
                      min(len(top), symbols - 2))


def _pack(p: recurrent.Parameters) -> bytes:
    return b"".join(p[k].astype("<f4").tobytes() for k in sorted(p))


def _unpack(data: np.ndarray, like: recurrent.Parameters) -> recurrent.Parameters:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = data[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _row_hash(*more):
    """Of the whole row: documents without a doc_id would all be in one share and shard."""
    return F.xxhash64("doc_id", "text", *more)


#: Trained copies averaged by one task.
FAN_IN = 8


def train_round(texts: DataFrame, model: _Model, shards: int) -> None:
    """texts: doc_id, text. Trains a copy per shard and sets the model to their mean,
    weighted by symbols."""
    send = texts.sparkSession.sparkContext.broadcast(model)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = send.value
        p = {k: v.copy() for k, v in own.parameters.items()}
        optimiser, symbols = recurrent.Adam(p, RATE), 0
        for batch in batches:
            encoded = [own.encode_words(lower_words(t)) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            symbols += recurrent.train(p, own.layout, encoded, own.end, optimiser)[1]
        if symbols:
            yield pa.RecordBatch.from_arrays([pa.array([symbols], pa.int64()), pa.array([_pack(p)], pa.binary())],
                                             ["symbols", "parameters"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = None, 0
        for batch in batches:
            for n, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(data, "<f4").astype(float) * n
                total, weight = part if total is None else total + part, weight + n
        if weight:
            yield pa.RecordBatch.from_arrays([pa.array([weight], pa.int64()),
                                              pa.array([(total / weight).astype("<f4").tobytes()], pa.binary())],
                                             ["symbols", "parameters"])

    kind = "symbols long, parameters binary"
    dealt = texts.withColumn("shard", F.pmod(_row_hash(F.lit(3)), F.lit(shards)))
    fitted = dealt.repartition(shards, "shard").sortWithinPartitions(_row_hash(), "doc_id", "text").mapInArrow(fit, kind)
    # a tree of means: a task takes about FAN_IN copies, whatever the number of shards
    copies, n = stored(fitted), shards
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        copies = stored(copies.repartition(n).mapInArrow(add, kind))
    copies = copies.collect()  # FAN_IN rows at most
    weight = sum(r["symbols"] for r in copies)
    if weight:
        mean = sum(np.frombuffer(r["parameters"], "<f4").astype(float) * (r["symbols"] / weight) for r in copies)
        model.parameters = _unpack(mean, model.parameters)


def score_documents(docs: DataFrame, rounds: int = ROUNDS, share: int = SHARE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per document row."""
    if share > rounds:
        raise ValueError("fewer rounds than shares: some training documents would not be learnt from")
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    teaching = rows.filter(~_held_out())
    counts = stored(count_words(teaching))
    vocabulary = learn_vocabulary(counts, teaching.count())
    words = spark.sparkContext.broadcast(vocabulary)
    model = _Model(vocabulary)
    shards = max(6, round(vocabulary.tokens / share / SHARD_TOKENS))
    for k in range(rounds):
        train_round(teaching.filter(F.pmod(_row_hash(), F.lit(share)) == k), model, shards)
    send = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, v = send.value, words.value
        log_count = np.append(np.log10(v.count + 1.0), 0.0)
        end_base = np.log10(v.ends + 1.0)
        names = ["n_tokens", "n_known", "hot_base", "hot_score", "n_other", "words", "times"]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.binary()),
                 pa.list_(pa.int64())]
        for batch in batches:
            encoded, out = [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                tokens = lower_words(text)
                places = _places(v.place, tokens)
                rare = Counter(tokens[i] for i in np.flatnonzero(places < 0))
                others = (places < 0) | (places >= v.shortlist)
                encoded.append(own.encode(places))
                out.append((len(tokens) + 1, int((places >= 0).sum()) + (1 if v.ends else 0),
                            float(log_count[places].sum() + end_base),
                            float(log_count[places[others]].sum()), int(others.sum()),
                            list(rare), list(rare.values())))
            logs = recurrent.score(own.parameters, own.layout, encoded, own.end) / np.log(10)
            columns = [list(c) for c in zip(*out)] or [[] for _ in names]
            columns[3] = [float(a + b) for a, b in zip(columns[3], logs)] if out else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, kinds)]],
                ["row_id", "doc_id", *names])

    scored = stored(with_row_number(rows).mapInArrow(
        run, "row_id long, doc_id long, n_tokens long, n_known long, hot_base double, hot_score double, "
             "n_other long, words array<binary>, times array<long>"))
    rare = (scored.select("row_id", F.explode(F.arrays_zip("words", "times")).alias("w"))
            .select("row_id", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
            .join(counts, "word")  # words without a count add log10(0 + 1) = 0
            .groupBy("row_id").agg(F.sum("times").alias("known"),
                                   F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("logs")))
    joined = scored.drop("words", "times").join(rare, "row_id", "left")
    logs, known = F.coalesce("logs", F.lit(0.0)), F.coalesce("known", F.lit(0))
    return joined.select(
        "doc_id", _held_out().alias("held_out"), "n_tokens", (F.col("n_known") + known).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("hot_base") + logs - F.col("n_tokens") * float(np.log10(vocabulary.divisor))).alias("base_score"),
        (F.col("hot_score") + logs - F.col("n_other") * float(np.log10(vocabulary.other_divisor))).alias("score"))
