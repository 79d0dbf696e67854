"""Operator 10: mix sources to target weights by hash-threshold histograms.

DataFrame functions only. Words are summed by source and hash bucket (three
hex digits of ``md5(doc_id)``); running sums over a source's buckets find the
bucket in which its budget ends; only that bucket is split again by the next
three digits, until the boundary is a single hash. A document is taken when its
hash lies below its source's threshold, so nothing is sorted and no document
row is gathered by source: the join key is (source, bucket).

Defined cases: null text counts no words; a null source is a source of its own
and comes last; a null doc_id has one fixed hash; rows with equal doc_id have
one hash and are taken together; a source without words takes nothing; an empty
table gives an empty result; further columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.llm.common import stored, text_of, words_native

#: Weights given to the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: All targets together, as a share of all words.
SHARE = 1.5
#: No source and no document is taken more often than this.
MAX_REPEATS = 2
DIGITS = 3


def _keys(docs: DataFrame) -> dict[str, Column]:
    h = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return {
        # "s..." sorts before "~", which stands for the null source
        "k": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("~")),
        "h": h,
        "b": F.substring(h, 1, DIGITS),
    }


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, repeats=MAX_REPEATS) -> DataFrame:
    """``sizes``: one row per source (k, source_size). Adds target.

    Targets are ``least(repeats * size, level * weight)``; the level that spends
    the whole budget is the largest of the levels got by capping the sources in
    order of their size per weight. The windows run over one row per source.
    """
    by_name = Window.orderBy("k")
    rank = F.row_number().over(by_name)
    cap = F.col("source_size") * F.lit(repeats)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    s = (sizes.withColumn("weight", weight).withColumn("cap", cap.cast("double"))
         .withColumn("ratio", F.col("cap") / F.col("weight")))
    order = Window.orderBy("ratio", "k")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy("ratio", "k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(share))
                               - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(rest))
    s = s.withColumn("level", F.max("level").over(everything))
    return s.select("k", "source_size",
                    F.least(F.col("cap"), F.col("level") * F.col("weight")).alias("target"))


def _boundary(hist: DataFrame) -> DataFrame:
    """hist: (k, budget, base, bucket, words, lo, hi) with the words before the
    buckets in base. One row per source whose budget ends in one of them."""
    w = Window.partitionBy("k").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("base") + F.sum("words").over(w)
    return (hist.withColumn("upto", upto)
            .withColumn("base", F.col("upto") - F.col("words"))
            .filter((F.col("base") <= F.col("budget")) & (F.col("upto") > F.col("budget")))
            .select("k", "budget", "base", "bucket", "upto", "lo", "hi"))


def thresholds(slim: DataFrame, hist: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per source: whole copies, threshold hash, and whether the
    threshold itself is taken."""
    spark = slim.sparkSession
    copies = F.when(F.col("source_size") > 0,
                    F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MAX_REPEATS))
                    ).otherwise(0).cast("long")
    plan = stored(sources.withColumn("copies", copies)
                  .withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size")))
    level = stored(_boundary(hist.join(plan.select("k", "budget"), "k")
                             .withColumn("base", F.lit(0).cast("long"))
                             .withColumnRenamed("b", "bucket")))
    found, digits = [], DIGITS
    while True:
        single = F.col("lo") == F.col("hi")
        # the boundary hash is taken when that ends nearer to the budget
        found.append(level.filter(single).select(
            "k", F.col("lo").alias("threshold"),
            ((F.col("upto") - F.col("budget")) < (F.col("budget") - F.col("base"))).alias("inclusive")))
        open_ = level.filter(~single)
        if digits >= 32 or open_.isEmpty():
            break
        digits = min(32, digits + DIGITS)
        inside = (slim.join(open_.select("k", "budget", "base", F.col("bucket").alias("prefix"),
                                         F.substring("bucket", 1, DIGITS).alias("b")), ["k", "b"])
                  .filter(F.col("h").startswith(F.col("prefix"))))
        level = stored(_boundary(
            inside.groupBy("k", "budget", "base", F.substring("h", 1, digits).alias("bucket"))
            .agg(F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi"))))
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return (plan.join(edges, "k", "left")
            .select("k", "source_size", "target", "copies",
                    F.coalesce("threshold", F.lit("")).alias("threshold"),
                    F.coalesce("inclusive", F.lit(False)).alias("inclusive")))


def _plan(docs: DataFrame, weights, share) -> tuple[DataFrame, DataFrame]:
    """(slim rows, plan per source and bucket)."""
    keys = _keys(docs)
    slim = stored(docs.select(
        "doc_id", *[c.alias(n) for n, c in keys.items()],
        F.size(words_native(text_of())).cast("long").alias("size")))
    hist = stored(slim.groupBy("k", "b").agg(F.sum("size").alias("words"), F.min("h").alias("lo"),
                                             F.max("h").alias("hi")))
    sources = source_targets(hist.groupBy("k").agg(F.sum("words").alias("source_size")), weights, share)
    cut = thresholds(slim, hist, sources)
    return slim, stored(hist.select("k", "b").join(cut, "k"))


def _taken_copies() -> Column:
    below = (F.col("h") < F.col("threshold")) | ((F.col("h") == F.col("threshold")) & F.col("inclusive"))
    return F.least(F.col("copies") + F.when(below & (F.col("copies") < MAX_REPEATS), 1).otherwise(0),
                   F.lit(MAX_REPEATS))


def mix_plan(docs: DataFrame, weights=WEIGHTS, share=SHARE) -> DataFrame:
    """doc_id, size, source_size, target, taken per document row."""
    slim, plan = _plan(docs, weights, share)
    return slim.join(plan, ["k", "b"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _taken_copies()).alias("taken"))


def mix_documents(docs: DataFrame, weights=WEIGHTS, share=SHARE) -> DataFrame:
    """The mix itself: documents with all their columns, repeated as planned."""
    _, plan = _plan(docs, weights, share)
    rows = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in _keys(docs).items()])
    picked = rows.join(plan, ["k", "b"]).select("row", _taken_copies().cast("int").alias("n")).filter("n > 0")
    return picked.select("row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")).select("row.*")
