"""Operator 11: audit of how sources of a language differ, by dominance skybands.

Terms are runs of ASCII letters (lower-cased) and characters beyond ASCII. A language keeps
the terms of at least ``LEAST_DOCS`` of its documents. Every (lang, source) group and every
language gives each kept term the share p = 1 + floor(10^9 (count + 5) / (N + 5 V)).

1. Tasks count terms per group with bounded memory; counts are summed, and the groups of a
   (lang, term) are listed in one row (a row lists a source once). Rows below the bound go.
2. Term report: of two terms the one with no smaller count in the group, no greater count
   in the language and the earlier UTF-8 form comes before the other whatever N and V
   are. So the tasks keep, per batch and group, the terms that fewer than ``RANKS`` others
   dominate (its skyband; dominance is transitive, so it is enough to count dominators among
   those kept). Only skybands are shuffled; they are merged in rounds of ``FAN`` partitions, by
   the same rule, and what is left in the end is ranked exactly.
3. Pair report: shares of a source that lacks a term are one number, so the sum over all
   kept terms of |p - q| is V |p0 - q0| plus a correction for terms that either source
   has. Sources are numbered per language and dealt to blocks of ``BLOCK``; a task takes
   the terms of one chunk for one pair of blocks as a matrix and gives a partial sum per pair
   of sources. No row per term and pair is made.

All shares and sums are whole numbers. Defined cases: null text, lang and source are '';
documents without terms still make their group; a lang without kept terms has V = 0, so its
pairs have value 0; repeated rows count each; ties rank by UTF-8; no documents, no rows;
further columns are not read. One task holds the sources of a language (numbering) and
its pairs of a source (ranking), which the pair report holds anyway.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.llm.common import stored

LEAST_DOCS = 30
RANKS = 50
SHARE, PRIOR = 1_000_000_000, 5  # fixed values of the contract
#: Terms a task counts before it hands them on, partitions merged at a time, sources per
#: block, and terms per chunk of the pair report.
HELD = 200_000
FAN = 16
BLOCK = 128
CHUNK = 1024

_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: every other byte becomes a blank, A-Z become small."""
    return text.translate(_TERM_BYTES).split()


def _groups(docs: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(blank("lang"), blank("source"), blank("text"))


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, count, docs: occurrences and documents per group, summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0

        def row_batch():
            columns: list[list] = [[], [], [], [], []]
            for (lang, source), (count, documents) in held.items():
                for column, value in zip(columns, ([lang] * len(count), [source] * len(count), count.keys(),
                                                   count.values(), [documents[t] for t in count])):
                    column.extend(value)
            types = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              ["lang", "source", "term", "count", "docs"])

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
                found = terms(text.as_py())
                if not found:
                    continue
                count, documents = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(count)
                count.update(found)
                documents.update(set(found))
                size += len(count)
                if size > HELD:
                    yield row_batch()
                    held, size = {}, 0
        if held:
            yield row_batch()

    counted = docs.mapInArrow(run, "lang string, source string, term binary, count long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term, total (occurrences in the language), own (source and count, per group that
    has the term)."""
    return count_terms(docs).groupBy("lang", "term").agg(
        F.sum("count").alias("total"), F.sum("docs").alias("docs"),
        F.collect_list(F.struct("source", "count")).alias("own")).filter(F.col("docs") >= least_docs).drop("docs")


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (N + 5 V)), exact."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", wide(F.lit(SHARE)) * wide(count + PRIOR), wide(n + PRIOR * v))


def describe_groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Per (lang, source): n (its occurrences of kept terms), lang_n, v, number (from 0 in
    its language), p0 (share of a term it lacks)."""
    own = kept.select("lang", F.explode("own").alias("o")).groupBy("lang", F.col("o.source").alias("source")).agg(
        F.sum("o.count").alias("n"))
    langs = kept.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count(F.lit(1)).alias("v"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    every = docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    every = every.select("lang", "source", zero("n"), zero("lang_n"), zero("v"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    p0 = F.when(F.col("v") > 0, share(F.lit(0), F.col("n"), F.col("v"))).otherwise(0)
    return every.select("*", number.alias("number"), p0.alias("p0"))


# --- term report ----------------------------------------------------------------------
class Skyband:
    """Keeps points, given in an order in which dominators come first, that fewer than ``k``
    kept points dominate: counts are already falling, so a dominator is a kept point of no
    greater ``low`` and a smaller ``place``. A Fenwick tree over ranks of ``low`` holds the
    ``k`` smallest places per node."""

    def __init__(self, lows: int, k: int):
        self.k, self.nodes = k, [[] for _ in range(lows + 1)]

    def keeps(self, low: int, place: int) -> bool:
        dominators, i = 0, low + 1
        while i:
            dominators += bisect_left(self.nodes[i], place)
            if dominators >= self.k:
                return False
            i &= i - 1
        i = low + 1
        while i < len(self.nodes):
            node = self.nodes[i]
            if len(node) < self.k or place < node[-1]:
                insort(node, place)
                del node[self.k:]
            i += i & -i
        return True


def skyband(count: np.ndarray, total: np.ndarray, term: list[bytes], k: int) -> np.ndarray:
    """Which points stay (their indices)."""
    place = np.empty(len(term), np.int64)
    place[np.array(sorted(range(len(term)), key=term.__getitem__), np.int64)] = np.arange(len(term))
    lows, low = np.unique(total, return_inverse=True)
    order = np.lexsort((place, low, -count))
    band = Skyband(len(lows), k)
    stays = [band.keeps(a, b) for a, b in zip(low[order].tolist(), place[order].tolist())]
    return order[np.array(stays, bool)]


_POINT = "lang string, source string, term binary, count long, total long, slot long"


def _band(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    return frame.iloc[skyband(frame["count"].to_numpy(), frame["total"].to_numpy(), frame["term"].tolist(), k)]


def _own_bands(kept: DataFrame, ranks: int) -> DataFrame:
    """Skybands of every batch of a partition, before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = TaskContext.get().partitionId()
        for batch in batches:
            own = batch.column("own")
            row, entry = pc.list_parent_indices(own), own.flatten()
            points = pa.table({"lang": batch.column("lang").take(row), "source": entry.field("source"),
                               "term": batch.column("term").take(row), "count": entry.field("count"),
                               "total": batch.column("total").take(row)}).to_pandas()
            for _, frame in points.groupby(["lang", "source"], sort=False):
                yield pa.RecordBatch.from_pandas(_band(frame, ranks).assign(slot=slot), preserve_index=False)

    return kept.select("lang", "term", "total", "own").mapInArrow(run, _POINT)


def skybands(kept: DataFrame, ranks: int = RANKS) -> DataFrame:
    """lang, source, term, count, total of every group's skyband, of which up to ``FAN`` parts
    are left to the ranking: a group with a third of all terms is in no task alone."""
    points = stored(_own_bands(kept, ranks))
    slots = (points.agg(F.max("slot")).first()[0] or 0) + 1
    while True:
        slot = F.floor(F.col("slot") / FAN).cast("long")
        points = points.groupBy("lang", "source", slot.alias("next")).applyInPandas(
            lambda frame: _band(frame, ranks).assign(slot=frame["slot"] // FAN), _POINT)
        slots = -(-slots // FAN)
        if slots <= FAN:
            return points.drop("slot")
        points = stored(points)


def rank_terms(bands: DataFrame, groups: DataFrame, ranks: int = RANKS) -> DataFrame:
    joined = bands.join(groups, ["lang", "source"])
    value = share(F.col("count"), F.col("n"), F.col("v")) - share(F.col("total"), F.col("lang_n"), F.col("v"))
    rows = joined.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"),
                         value.alias("value")).filter("value > 0")
    return _ranked(rows).filter(F.col("rank") <= ranks)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


# --- pair report ----------------------------------------------------------------------
def _chunk_sums(frame: pd.DataFrame, size: int) -> pd.DataFrame:
    """Corrections of a chunk for one pair of blocks of ``size`` sources: the sum over its
    terms of |p - q| - |p0 - q0|."""
    heads = frame[frame["term"].isna()]
    rows = frame[frame["term"].notna()]
    sides = []
    number = {t: i for i, t in enumerate(rows["term"].unique())}
    for side in (0, 1):
        head = heads[heads["side"] == side].iloc[0]
        dense = np.tile(np.asarray(head["p"], np.int64), (len(number), 1))
        for term, numbers, p in rows.loc[rows["side"] == side, ["term", "number", "p"]].itertuples(index=False):
            dense[number[term], np.asarray(numbers) % size] = p
        sides.append((np.asarray(head["number"], np.int64), np.asarray(head["p"], np.int64), dense))
    (a, p0, left), (b, q0, right) = sides
    total = np.zeros((len(a), len(b)), np.int64)
    for i in range(len(a)):
        total[i] = np.abs(left[:, i, None] - right).sum(axis=0)
    total -= len(number) * np.abs(p0[:, None] - q0[None, :])
    i, j = np.nonzero((a[:, None] < b[None, :]) & (total != 0))
    return pd.DataFrame({"lang": heads["lang"].iloc[0], "a": a[i], "b": b[j], "part": total[i, j]})


def pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (numbers, a < b), part: corrections summed over all kept terms."""
    entry = F.struct("number", share(F.col("o.count"), F.col("n"), F.col("v")).alias("p"))
    shares = (kept.select("lang", "term", F.explode("own").alias("o")).withColumn("source", F.col("o.source"))
              .join(groups.select("lang", "source", "number", "n", "v"), ["lang", "source"])
              .groupBy("lang", "term", F.floor(F.col("number") / BLOCK).alias("block"),
                       F.pmod(F.xxhash64("term"), F.floor(F.col("v") / CHUNK) + 1).alias("chunk"))
              .agg(F.collect_list(entry).alias("e")))  # at most BLOCK sources
    sizes = groups.groupBy("lang").agg((F.floor(F.max("number") / BLOCK) + 1).alias("blocks"), F.max("v").alias("v"))
    heads = (groups.groupBy("lang", F.floor(F.col("number") / BLOCK).alias("block"))
             .agg(F.array_sort(F.collect_list(F.struct("number", "p0"))).alias("e")).join(sizes, "lang")
             .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("v") / CHUNK)))))
    flat = lambda p: (F.col("e.number").cast("array<long>").alias("number"), F.col(f"e.{p}").cast("array<long>").alias("p"))
    rows = shares.join(sizes.drop("v"), "lang").select("lang", "term", "block", "chunk", "blocks", *flat("p")).unionByName(
        heads.select("lang", F.lit(None).cast("binary").alias("term"), "block", "chunk", "blocks", *flat("p0")))
    # a block is the left side of pairs with itself and later ones, the right side of pairs with
    # itself and earlier ones
    with_others = F.explode(F.concat(
        F.transform(F.sequence(F.col("block"), F.col("blocks") - 1),
                    lambda o: F.struct(F.lit(0).alias("side"), F.col("block").alias("x"), o.alias("y"))),
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("block")),
                    lambda o: F.struct(F.lit(1).alias("side"), o.alias("x"), F.col("block").alias("y")))))
    dealt = rows.select("lang", "term", "chunk", "number", "p", with_others.alias("w")).select(
        "lang", "term", "chunk", "number", "p", "w.*")
    size = BLOCK
    return (dealt.groupBy("lang", "chunk", "x", "y")
            .applyInPandas(lambda frame: _chunk_sums(frame, size), "lang string, a long, b long, part long")
            .groupBy("lang", "a", "b").agg(F.sum("part").alias("part")))


def rank_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    one = groups.select("lang", F.col("number").cast("long").alias("a"), "source", "p0", "v")
    other = groups.select("lang", F.col("number").cast("long").alias("b"), F.col("source").alias("item"), F.col("p0").alias("q0"))
    sums = pair_sums(kept, groups)
    both = sums.unionByName(sums.select("lang", F.col("a").alias("b"), F.col("b").alias("a"), "part"))
    # the result holds every pair of sources of a language
    pairs = one.join(other, "lang").filter("a <> b").join(both, ["lang", "a", "b"], "left")
    value = F.col("v") * F.abs(F.col("p0") - F.col("q0")) + F.coalesce("part", F.lit(0))
    return _ranked(pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")))


def audit(documents: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """lang, source, part, item, value, rank."""
    docs = _groups(documents)
    kept = stored(kept_terms(docs, least_docs))
    groups = stored(describe_groups(docs, kept))
    return rank_pairs(kept, groups).unionByName(rank_terms(skybands(kept, ranks), groups, ranks))
