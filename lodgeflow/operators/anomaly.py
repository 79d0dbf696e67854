"""Volume and dimension anomaly detection over time buckets.

Buckets are one day by default (the reference's setting); ``period`` also
accepts ``hour`` and ``week``.

1. rows per bucket (and per dimension value) — a partial aggregate, so hot
   buckets/values are combined map-side;
2. zero-filled between the first and last bucket of the data, per value;
3. days inside the detection delay before ``as_of`` are dropped;
4. each bucket is scored against the trailing ``training`` buckets
   (exclusive of itself) with a window over the *aggregated* series;
5. anomalous if enough training buckets exist, the z-score exceeds
   ``sigmas`` (or the training stddev is 0) and the percent change vs. the
   training mean exceeds the spike/drop threshold in its direction.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



PERIODS = ("hour", "day", "week")


def _bucket(ts: Column, period: str) -> Column:
    if period not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}, not {period!r}")
    # day buckets stay DATEs; hour and week buckets are truncated timestamps
    return F.to_date(ts) if period == "day" else F.date_trunc(period, ts)


def bucket_counts(df: DataFrame, ts_col: str, dims: Sequence[str] = (),
                  period: str = "day") -> DataFrame:
    """Rows per (bucket, *dims)."""
    return (df.groupBy(_bucket(F.col(ts_col), period).alias("bucket"), *dims)
            .agg(F.count(F.lit(1)).alias("row_count")))


def zero_fill(counts: DataFrame, dims: Sequence[str] = (), period: str = "day") -> DataFrame:
    """Every day between the global first and last bucket, per dimension value.

    The bounds are scalar subqueries; each distinct dimension value expands
    its own ``sequence`` of days — no cross join.
    """
    lo = counts.select(F.min("bucket")).scalar()
    hi = counts.select(F.max("bucket")).scalar()
    keys = counts.select(*dims).distinct() if dims else counts.sparkSession.range(1).select()
    step = F.expr(f"INTERVAL 1 {period.upper()}")
    grid = keys.select(*dims, F.explode(F.sequence(lo, hi, step)).alias("bucket"))
    cond = [F.col("g.bucket") == F.col("c.bucket")] + [
        F.col(f"g.{d}").eqNullSafe(F.col(f"c.{d}")) for d in dims]
    joined = grid.alias("g").join(counts.alias("c"), reduce(lambda a, b: a & b, cond), "left")
    return joined.select(F.col("g.bucket").alias("bucket"),
                         *[F.col(f"g.{d}").alias(d) for d in dims],
                         F.coalesce(F.col("c.row_count"), F.lit(0)).cast("bigint").alias("row_count"))


def _as_date(value):
    if isinstance(value, _dt.datetime):
        return F.lit(value.date().isoformat()).cast("date")
    if isinstance(value, _dt.date):
        return F.lit(value.isoformat()).cast("date")
    return F.to_date(F.lit(str(value)).cast("timestamp_ntz"))


def score_series(series: DataFrame, dims: Sequence[str] = (), training: int = 14,
                 min_training: int = 7, sigmas: float = 3.0,
                 spike_pct: float = 10.0, drop_pct: float = 5.0,
                 direction: str = "both") -> DataFrame:
    """Score every bucket that has at least ``min_training`` training buckets."""
    w = Window.partitionBy(*dims).orderBy("bucket").rowsBetween(-training, -1)
    n = F.col("row_count")
    scored = series.select(
        "bucket", *dims, "row_count",
        F.avg(n).over(w).alias("training_avg"),
        F.stddev_samp(n).over(w).alias("training_stddev"),
        F.count(n).over(w).alias("training_count"))
    avg, sd = F.col("training_avg"), F.col("training_stddev")
    z = F.when(sd > 0, (n - avg) / sd)
    pct = F.when(avg != 0, (n - avg) * 100.0 / avg)
    flat = F.coalesce(sd, F.lit(0.0)) == 0  # no spread: judge by percent only
    spike = (n > avg) & (flat | (z > sigmas)) & (pct.isNull() | (pct > spike_pct))
    drop = (n < avg) & (flat | (z < -sigmas)) & (pct.isNull() | (-pct > drop_pct))
    if direction == "spike":
        drop = F.lit(False)
    elif direction == "drop":
        spike = F.lit(False)
    elif direction != "both":
        raise ValueError(f"direction must be both, spike or drop, not {direction!r}")
    return (scored.filter(F.col("training_count") >= min_training)
            .select("bucket", *dims, "row_count",
                    F.round(avg, 4).alias("training_avg"),
                    F.round(sd, 4).alias("training_stddev"),
                    F.col("training_count").cast("bigint").alias("training_count"),
                    F.round(z, 4).alias("z_score"),
                    F.round(pct, 4).alias("pct_change"),
                    F.when(spike, F.lit("spike")).when(drop, F.lit("drop")).alias("anomaly")))


def anomaly_scores(df: DataFrame, ts_col: str, dims: Sequence[str] = (), as_of=None,
                   detection_delay_days: int = 0, period: str = "day", **kw) -> DataFrame:
    """Zero-filled, delay-trimmed, scored series of ``df`` in ``period`` buckets."""
    series = zero_fill(bucket_counts(df, ts_col, dims, period), dims, period)
    if as_of is not None and detection_delay_days:
        cutoff = F.date_sub(_as_date(as_of), detection_delay_days)
        # whole buckets before the delay
        bucket_day = F.col("bucket") if period == "day" else F.to_date(F.col("bucket"))
        series = series.filter(bucket_day < cutoff)
    return score_series(series, dims, **kw)


def volume_anomalies(df: DataFrame, ts_col: str, as_of=None, detection_delay_days: int = 1,
                     spike_pct: float = 10.0, drop_pct: float = 5.0, **kw) -> DataFrame:
    """Q24: anomalous daily row counts (failing rows)."""
    return (anomaly_scores(df, ts_col, (), as_of, detection_delay_days,
                           spike_pct=spike_pct, drop_pct=drop_pct, **kw)
            .filter(F.col("anomaly").isNotNull()))


def dimension_anomalies(df: DataFrame, ts_col: str, dims: Sequence[str], as_of=None,
                        detection_delay_days: int = 0, spike_pct: float = 5.0,
                        drop_pct: float = 5.0, **kw) -> DataFrame:
    """Q25: anomalous daily row counts per dimension value (failing rows)."""
    return (anomaly_scores(df, ts_col, dims, as_of, detection_delay_days,
                           spike_pct=spike_pct, drop_pct=drop_pct, **kw)
            .filter(F.col("anomaly").isNotNull()))
