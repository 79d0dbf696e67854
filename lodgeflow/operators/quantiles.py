"""Exact weighted percentiles by histogram refinement.

``percentile_cont(p)`` of a group is the value at rank ``p·(n−1)``,
interpolated between the values at ranks ``floor`` and ``ceil``. Spark's
``percentile`` aggregate gets there by merging a map of every distinct value
of a group into one task, and a global sort shuffles all values; here the values
stay where they are:

1. one aggregate gives every group its rows, least and greatest value;
2. a histogram of ``BUCKETS`` buckets between these counts the weights (a
   partial aggregate: a task hands on one row per bucket it meets, however many
   rows fall into it, so a hot group or value costs no more than another);
3. a running sum over a group's buckets finds the bucket that holds a wanted rank;
   its least and greatest value are the next range, and only values inside
   such ranges are looked at again;
4. a range of one value is the answer; a range of at most ``SORTED`` rows is sorted
   (they are the only rows ever shuffled); other ranges are refined again.

The buckets only have to rise with the value, which double arithmetic does, and the
least and the greatest value of a range have buckets of their own, so every pass
shrinks a range and the result is exact for any type: values are never
rounded, whole numbers beyond 2^53 and decimals included. A NULL group is a group
like any other: all joins on it are null-safe.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeflow.session import reliable_checkpoint

#: Buckets of a pass, and the rows of a range that may be sorted in one task.
BUCKETS = 4096
SORTED = 1 << 20


def _above(x: Column, lo: Column, hi: Column, kind: T.DataType) -> Column:
    """``x − lo`` as double: never overflows, rises with ``x`` (``lo <= x <= hi``)."""
    halves = x.cast("double") / 2 - lo.cast("double") / 2
    if isinstance(kind, T.IntegralType):  # exact wherever the difference fits a long
        fits = hi.cast("double") - lo.cast("double") < 9e18
        return F.when(fits, (x.cast("long") - lo.cast("long")).cast("double") / 2).otherwise(halves)
    if isinstance(kind, T.DecimalType) and kind.precision < 38:
        return (x - lo).cast("double") / 2
    return halves


def _bucket(x: Column, lo: Column, hi: Column, kind: T.DataType) -> Column:
    share = _above(x, lo, hi, kind) / _above(hi, lo, hi, kind)
    inner = F.least(F.floor(F.nanvl(share, F.lit(0.0)) * BUCKETS), F.lit(BUCKETS - 1))
    return F.when(x == lo, F.lit(-1)).when(x == hi, F.lit(BUCKETS)).otherwise(inner).cast("int")


def _ranges(wanted: DataFrame) -> DataFrame:
    """Distinct open ranges; those of one group do not overlap."""
    return wanted.filter("lo <> hi").select(F.col("g").alias("rg"), "lo", "hi", "before").distinct()


def _inside(values: DataFrame, ranges: DataFrame) -> DataFrame:
    c = F.col
    return values.join(ranges, c("g").eqNullSafe(c("rg")) & (c("x") >= c("lo")) & (c("x") <= c("hi")))


def _held(wanted: DataFrame, parts: DataFrame) -> DataFrame:
    """Wanted ranks with the part (value or bucket) of their range that holds them.
    ``parts``: rg, lo, start, end (ranks), and the columns next_*."""
    parts = parts.withColumnRenamed("lo", "range_lo")
    c = F.col
    return wanted.join(parts, c("g").eqNullSafe(c("rg")) & (c("lo") == c("range_lo"))
                       & (c("k") >= c("start")) & (c("k") < c("end")))


def _with_ranks(parts: DataFrame, order: str) -> DataFrame:
    """start and end ranks of the parts of each range."""
    upto = Window.partitionBy("rg", "lo").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("before") + F.sum("w").over(upto)
    return parts.withColumn("end", end).withColumn("start", F.col("end") - F.col("w"))


def select_ranks(values: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``(g, k, n, value)``: the value at rank k (from 0) of each group, for all ranks that
    the percentiles ``probs`` need. ``values``: g, x (not null), w (stored)."""
    kind = values.schema["x"].dataType
    groups = values.groupBy("g").agg(F.sum("w").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"),
                                     F.count(F.lit(1)).alias("rows"))
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(*_ends(p, F.col("n"))) for p in probs])))
    wanted = reliable_checkpoint(groups.select("g", "n", F.explode(ranks).alias("k"), "lo", "hi",
                                               F.lit(0).cast("bigint").alias("before"), "rows"))
    columns = ["g", "n", "k", "lo", "hi", "before", "rows"]
    left, narrowed = values, False
    while (most := wanted.filter("lo <> hi").agg(F.max("rows")).first()[0]) is not None:
        ranges = _ranges(wanted)
        if most <= SORTED:
            each = _inside(left, ranges).groupBy("rg", "lo", "before", "x").agg(F.sum("w").alias("w"))
            parts = _with_ranks(each, "x").select("rg", "lo", "start", "end", F.col("x").alias("next_lo"),
                                                  F.col("x").alias("next_hi"), F.lit(1).cast("bigint").alias("next_rows"))
        else:
            if narrowed:  # what a pass has ruled out is not read again
                left = reliable_checkpoint(_inside(left, ranges).select("g", "x", "w"))
            bucket = _bucket(F.col("x"), F.col("lo"), F.col("hi"), kind).alias("bucket")
            counted = _inside(left, ranges).groupBy("rg", "lo", "before", bucket).agg(
                F.sum("w").alias("w"), F.min("x").alias("next_lo"), F.max("x").alias("next_hi"),
                F.count(F.lit(1)).alias("next_rows"))
            # at most BUCKETS + 2 rows per range
            parts = _with_ranks(counted, "bucket").select("rg", "lo", "start", "end", "next_lo", "next_hi", "next_rows")
            narrowed = True
        held = _held(wanted.filter("lo <> hi"), parts).select(
            "g", "n", "k", F.col("next_lo").alias("lo"), F.col("next_hi").alias("hi"),
            F.col("start").alias("before"), F.col("next_rows").alias("rows"))
        wanted = wanted.filter("lo = hi").select(*columns).unionByName(held)
        if most <= SORTED:  # every open range has been sorted
            break
        wanted = reliable_checkpoint(wanted)
    return wanted.select("g", "k", "n", F.col("lo").alias("value"))


def _ends(p: float, n: Column) -> list[Column]:
    """Ranks that bracket percentile ``p`` of ``n`` values."""
    at = F.lit(float(p)) * (n - 1)
    return [F.floor(at).cast("bigint"), F.ceil(at).cast("bigint")]


def exact_percentiles(values: DataFrame, group: str, x: str, w: str | None,
                      probs: Sequence[float], prefix: str = "q", stored: bool = False) -> DataFrame:
    """``(group, q0, q1, …)``: exact continuous percentiles of ``x`` per group,
    each row weighted by ``w`` (1 when ``None``).

    Eager. The values are read up to three times, so they are stored first (the three
    columns, without a shuffle) unless ``stored`` says that reading them is cheap.
    """
    c = F.col(x)
    kind = values.schema[x].dataType
    v = values.select(F.col(group).alias("g"), (c if isinstance(kind, T.NumericType) else c.cast("double")).alias("x"),
                      (F.col(w) if w else F.lit(1)).cast("bigint").alias("w")).filter("x IS NOT NULL AND w > 0")
    found = select_ranks(v if stored else reliable_checkpoint(v), probs)
    aggs, outs = [], []
    for i, p in enumerate(probs):
        low, high = _ends(p, F.col("n"))
        aggs += [F.max(F.when(F.col("k") == k, F.col("value"))).cast("double").alias(f"__{tag}{i}")
                 for tag, k in (("lo", low), ("hi", high))]
        lo, hi, at = F.col(f"__lo{i}"), F.col(f"__hi{i}"), F.lit(float(p)) * (F.col("__n") - 1)
        # equal ends are not interpolated (an infinite one stays what it is)
        outs.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (at - F.floor(at))).alias(f"{prefix}{i}"))
    return found.groupBy(F.col("g").alias(group)).agg(F.max("n").alias("__n"), *aggs).select(group, *outs)


def approx_percentiles(values: DataFrame, group: str, x: str, probs: Sequence[float],
                       accuracy: int = 10_000, prefix: str = "q") -> DataFrame:
    """``(group, q0, …)`` from ``percentile_approx`` (a mergeable sketch per
    group, one pass, bounded memory): rank error at most ``1 / accuracy`` of
    the group size. For dashboards over very large columns where exactness is
    not required; exact results come from ``exact_percentiles``."""
    q = F.percentile_approx(F.col(x).cast("double"), [float(p) for p in probs], accuracy)
    return values.groupBy(group).agg(q.alias("__q")).select(
        group, *[F.col("__q")[i].alias(f"{prefix}{i}") for i in range(len(probs))])
