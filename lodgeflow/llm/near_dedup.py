"""Operator 9: MinHash near-duplicates, confirmed on full shingle sets.

1. Per document: distinct five-word shingles, ``BANDS * ROWS`` universal hash
   minima, one key per band, and a digest of the whole set.
2. Documents with equal sets form a class; only one document of each goes on.
3. Classes that share a band key are candidates. Within a bucket each class is
   compared with the bucket's least class only (a star). Members that are still outside
   their bucket's largest component are then compared with some of its members,
   (``TURNS`` times, with new ones); at last, classes that still lie in different
   components are compared pairwise where their set sizes allow the similarity. So
   a bucket of copies costs a few comparisons per member, and no candidate link
   between components is left out.
4. Pairs whose counts of shingles per hash cell bound their overlap too low go (this
   loses no link), then pairs whose signatures agree more than six standard errors
   too seldom; the rest is compared by full sets.
5. Components by alternating large-star and small-star.

Defined cases: null text is empty; documents without words are linked with
nothing; documents under five words have their whole sequence as one shingle;
repeated rows are copies of each other; a null doc_id counts after all others
(a component of null ids only has a null component_id); no documents, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import stored, text_of, with_row_number
from lodgeflow.llm.components import connected_components
from lodgeflow.llm.shingles import shingle_set

SHINGLE = 5
PERCENT = 75
BANDS = 32
ROWS = 4
BLOCK = 4096
#: Further pivots per bucket, and how often they are drawn.
PIVOTS = 8
TURNS = 1
#: Cells that a set's shingles are counted in, to bound what two sets share.
CELLS = 128

_random = np.random.default_rng(20240117)
_A = _random.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_B = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """Least value of each universal hash (a * x + b mod 2^64) over the set."""
    least = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        x = shingles[at:at + BLOCK]
        np.minimum(least, (_A[:, None] * x[None, :] + _B[:, None]).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> list[int]:
    """One signed 64-bit key per band, different between bands."""
    rows = least.reshape(BANDS, ROWS)
    return [xxhash.xxh3_64_intdigest(rows[i].tobytes(), seed=i) - (1 << 63) for i in range(BANDS)]


def signatures(rows: DataFrame) -> DataFrame:
    """rows: row_id, doc_id, text_hash, text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, bands, marks, spread = [], [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = shingle_set(text, SHINGLE)
                sizes.append(len(found))
                spread.append(np.bincount((found >> np.uint64(50)).astype(np.int64) % CELLS, minlength=CELLS)
                              .astype(np.int32) if len(found) else None)
                if len(found):
                    least = minima(found)
                    keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                    bands.append(band_keys(least))
                    marks.append((least >> np.uint64(48)).astype("<u2").tobytes())
                else:
                    keys.append(None)
                    bands.append(None)
                    marks.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), batch.column("text_hash"),
                 pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary()),
                 pa.array(spread, pa.list_(pa.int32()))],
                ["row_id", "doc_id", "text_hash", "n_shingles", "set_key", "bands", "marks", "spread"])

    return rows.mapInArrow(sign, "row_id long, doc_id long, text_hash long, n_shingles long, set_key binary, "
                                 "bands array<long>, marks binary, spread array<int>")


def _can_share_enough(a: str, b: str) -> Column:
    """False only for sets that cannot be similar enough: what they share is at most
    the sum over cells of the smaller count."""
    most = F.aggregate(F.zip_with(F.col(f"{a}spread"), F.col(f"{b}spread"), lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    return (100 + PERCENT) * most >= PERCENT * (F.col(f"{a}n_shingles") + F.col(f"{b}n_shingles"))


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (u, v) whose signatures and then full sets are similar enough."""
    total = BANDS * ROWS
    floor = PERCENT / 100 - 6 * (0.25 * 0.75 / total) ** 0.5

    def alike(left: Column, right: Column) -> Column:
        return F.pandas_udf(_agreement, "double")(left, right) >= F.lit(floor)

    side = lambda c: classes.select(F.col("node").alias(c), *[
        F.col(x).alias(f"{c}_{x}") for x in ("marks", "spread", "n_shingles")])
    near = (pairs.join(side("u"), "u").join(side("v"), "v").filter(_can_share_enough("u_", "v_"))
            .filter(alike(F.col("u_marks"), F.col("v_marks"))).select("u", "v"))
    full = (near.join(texts.select(F.col("node").alias("u"), F.col("text").alias("tu")), "u")
            .join(texts.select(F.col("node").alias("v"), F.col("text").alias("tv")), "v"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = []
            for a, b in zip(batch.column("tu").cast(pa.binary()).to_pylist(),
                            batch.column("tv").cast(pa.binary()).to_pylist()):
                x, y = shingle_set(a, SHINGLE), shingle_set(b, SHINGLE)
                both = len(np.intersect1d(x, y, assume_unique=True))
                yes.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select(["u", "v"]).filter(pa.array(yes, pa.bool_()))

    return full.select("u", "v", "tu", "tv").mapInArrow(confirm, "u long, v long")


def _agreement(left, right):
    import pandas as pd

    a = np.frombuffer(b"".join(left), "<u2").reshape(len(left), -1)
    b = np.frombuffer(b"".join(right), "<u2").reshape(len(right), -1)
    return pd.Series((a == b).mean(axis=1) if len(left) else np.empty(0))


def find_components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(signed rows, classes with component_id and winner per set_key)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    signed = stored(signatures(with_row_number(rows)))
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "row_id")
    classes = signed.filter("n_shingles > 0").groupBy("set_key").agg(
        F.min(first).alias("first"), F.min("row_id").alias("node"))
    classes = stored(classes.join(  # the bands of one member of each class
        signed.select(F.col("row_id").alias("node"), "n_shingles", "bands", "marks", "spread"), "node"))

    members = stored(classes.select("node", "n_shingles", F.explode("bands").alias("key"))
                     .join(_shared_keys(classes), "key"))
    wanted = members.select("node").distinct().join(classes.select("node", "first"), "node").select(
        "node", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"))
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_hash") == F.col("w.text_hash"))
    texts = stored(rows.alias("d").join(wanted.alias("w"), same).select("w.node", "d.text")
                   .dropDuplicates(["node"]))

    star = members.filter("node <> pivot AND " + _SIZES.format(a="n_shingles", b="pivot_size")).select(
        F.col("node").alias("u"), F.col("pivot").alias("v")).distinct()
    tied = connected_components(stored(_verified(star, classes, texts)))
    done = star
    for turn in range(TURNS):
        pairs = stored(_pivot_pairs(members, tied, turn).join(done, ["u", "v"], "left_anti"))
        tied = _joined(tied, stored(_verified(pairs, classes, texts)))
        done = done.unionByName(pairs)
    tied = _joined(tied, stored(_verified(_open_pairs(members, classes, tied, done), classes, texts)))

    rooted = classes.join(tied, "node", "left").select(
        "set_key", "first", F.coalesce("root", "node").alias("root"))
    winners = rooted.groupBy("root").agg(F.min("first").alias("winner"))
    return signed, rooted.join(winners, "root").select("set_key", "winner")


#: Sets of these sizes can reach the similarity at all.
_SIZES = f"100 * least({{a}}, {{b}}) >= {PERCENT} * greatest({{a}}, {{b}})"


def _shared_keys(classes: DataFrame) -> DataFrame:
    """Band keys that several classes have, with their least class."""
    keyed = classes.select(F.explode("bands").alias("key"), F.struct("node", "n_shingles").alias("c"))
    return (keyed.groupBy("key").agg(F.min("c").alias("p"), F.count(F.lit(1)).alias("size"))
            .filter("size > 1")
            .select("key", F.col("p.node").alias("pivot"), F.col("p.n_shingles").alias("pivot_size")))


def _joined(tied: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links: only the roots they tie are worked on."""
    at = lambda c: tied.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    rooted = links.join(at("u"), "u", "left").join(at("v"), "v", "left").select(
        F.coalesce("root_u", "u").alias("u"), F.coalesce("root_v", "v").alias("v"))
    over = connected_components(rooted).select(F.col("node").alias("root"), F.col("root").alias("over"))
    alone = links.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(tied, "node", "left_anti")
    nodes = tied.unionByName(alone.withColumn("root", F.col("node")))
    return stored(nodes.join(over, "root", "left").select("node", F.coalesce("over", "root").alias("root")))


def _open_members(members: DataFrame, tied: DataFrame) -> DataFrame:
    """Members of buckets that still hold several components, with root."""
    placed = members.join(tied, "node", "left").select(
        "key", "node", "n_shingles", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    return stored(placed.join(mixed.select("key"), "key"))


def _pivot_pairs(members: DataFrame, tied: DataFrame, turn: int) -> DataFrame:
    """In each open bucket, members outside its largest component against some of that
    component: copies of a large group that missed the first pivot find another."""
    open_ = _open_members(members, tied)
    sizes = tied.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    sized = open_.join(sizes, "root", "left").withColumn("size", F.coalesce("size", F.lit(1)))
    pick = lambda i: F.min(F.struct(
        (-F.col("size")).alias("s"), "root", F.xxhash64("node", F.lit(turn * PIVOTS + i)).alias("h"), "node", "n_shingles"))
    pivots = sized.groupBy("key").agg(F.array(*[pick(i) for i in range(PIVOTS)]).alias("p")).select(
        "key", F.explode(F.array_distinct("p")).alias("p"))
    pairs = open_.join(pivots, "key").filter(
        "root <> p.root AND " + _SIZES.format(a="n_shingles", b="p.n_shingles"))
    return pairs.select(F.greatest("node", F.col("p.node")).alias("u"), F.least("node", F.col("p.node")).alias("v")).distinct()


def _open_pairs(members: DataFrame, classes: DataFrame, tied: DataFrame, done: DataFrame) -> DataFrame:
    """Pairs within a bucket that lie in different components, can be similar enough and
    were not compared."""
    open_ = _open_members(members, tied).join(classes.select("node", "spread"), "node")
    a, b = open_.alias("a"), open_.alias("b")
    pairs = a.join(b, F.col("a.key") == F.col("b.key")).filter(
        F.expr("a.node > b.node AND a.root <> b.root AND " + _SIZES.format(a="a.n_shingles", b="b.n_shingles"))
        & _can_share_enough("a.", "b."))
    pairs = pairs.select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()
    return pairs.join(done, ["u", "v"], "left_anti")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per document row."""
    signed, found = find_components(docs)
    joined = signed.join(found, "set_key", "left")
    alone = F.col("winner").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("winner.doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group, with its columns; documents without words stay."""
    signed, found = find_components(docs)
    winners = (found.select("winner.doc_id", "winner.text_hash").distinct()
               .select(F.coalesce("doc_id", F.lit(-1)).alias("i"), F.col("doc_id").isNull().alias("n"), "text_hash"))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(text_of()).alias("text_hash"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("i"),
                       F.col("doc_id").isNull().alias("n"), F.regexp_like(text_of(), F.lit(r"[^\x20\x09-\x0D]")).alias("w"))
    keys = ["i", "n", "text_hash"]
    best = rows.filter("w").join(winners, keys).dropDuplicates(keys)
    return best.select("row.*").unionByName(rows.filter("NOT w").select("row.*"))
