"""Exact most frequent values (A10) without shuffling all distinct values.

1. One scan keeps a frequent-items sketch of value hashes per column (partial
   sketches merge, so a task hands on a few kilobytes per column whatever it reads).
2. The candidates it names are recounted exactly, by value.
3. A sketch that tracks m items misses a value by at most ``2 · 3.5 / m`` of all rows:
   it lists what occurs more often than its error for certain. If the best
   recounted value beats that bound, every value that could tie with it is a candidate,
   and the mode is proven. Else (no value stands out, as in a column of keys) the
   column is counted exactly, by 128-bit hashes of fixed width, and only the values of
   the greatest count are read again.

Ties go to the least value. NULL is no value.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.session import reliable_checkpoint

#: Items a sketch tracks (its table is the next power of two at three quarters' load),
#: and candidates named per column.
TRACKED = 10_000
NAMED = 64


def error_share(tracked: int = TRACKED) -> float:
    """The greatest share of all rows by which a sketch can miss a value."""
    table = 1
    while 0.75 * table < tracked:
        table *= 2
    return 2 * 3.5 / table


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def value_key(c: Column) -> tuple[Column, Column]:
    """128 bits that stand for a value."""
    return F.xxhash64(c), F.xxhash64(F.lit("second half"), c)


def sketch_aggs(columns: Sequence[str], tracked: int = TRACKED) -> list[Column]:
    """Aggregates that name the candidates of each column: arrays of (item, count)."""
    return [F.call_function("approx_top_k", F.xxhash64(_q(c)), F.lit(NAMED), F.lit(tracked)).alias(f"top{i}")
            for i, c in enumerate(columns)]


def _long(df: DataFrame, columns: Sequence[str], pick) -> DataFrame:
    """column_name with the fields of ``pick(column)`` per row and column whose value is there."""
    cells = F.array(*[F.when(_q(c).isNotNull(), F.struct(F.lit(c).alias("column_name"), *pick(_q(c)))) for c in columns])
    return df.select(F.explode(cells).alias("e")).filter("e IS NOT NULL").select("e.*")


def _text(c: Column) -> Column:
    return c.cast("string").alias("v")


def exact_modes(df: DataFrame, columns: Sequence[str], tracked: int = TRACKED,
                named: dict[str, list[tuple[int, int]]] | None = None, rows: int | None = None) -> DataFrame:
    """``(column_name, mode, mode_count)`` per column (mode as text; no row for a column
    without values). ``named`` and ``rows`` pass on candidates that a scan has already
    found with ``sketch_aggs``. Eager."""
    columns = list(columns)
    spark = df.sparkSession
    if named is None:
        found = df.agg(F.count(F.lit(1)).alias("rows"), *sketch_aggs(columns, tracked)).first()
        named, rows = read_sketches(found, columns), found["rows"]
    candidates = spark.createDataFrame([(c, h) for c in columns for h, _ in named[c]], "column_name string, h bigint")
    # at most NAMED rows per column
    cells = _long(df, columns, lambda c: (F.xxhash64(c).alias("h"), _text(c)))
    recounted = cells.join(F.broadcast(candidates), ["column_name", "h"]).groupBy("column_name", "v").agg(
        F.count(F.lit(1)).alias("n"))
    best = _best(recounted).collect()  # one row per column
    error = rows * error_share(tracked)
    proven = []
    for r in best:
        listed = named[r["column_name"]]
        # a full list may have cut off what counts less than its last entry
        bound = max(error, listed[-1][1] + error) if len(listed) >= NAMED else error
        if rows <= tracked * 3 // 4 and len(listed) < NAMED or r["mode_count"] > bound:
            proven.append((r["column_name"], r["mode"], r["mode_count"]))
    schema = "column_name string, mode string, mode_count bigint"
    out = spark.createDataFrame(proven, schema)
    rest = [c for c in columns if c not in {p[0] for p in proven}]
    return out.unionByName(counted_modes(df, rest)) if rest else out


def read_sketches(row, columns: Sequence[str]) -> dict[str, list[tuple[int, int]]]:
    """Candidates (hash, estimate) per column, most frequent first."""
    return {c: [(x["item"], x["count"]) for x in row[f"top{i}"] or [] if x["item"] is not None]
            for i, c in enumerate(columns)}


def _best(counts: DataFrame) -> DataFrame:
    """Greatest count, of equals the least value, per column."""
    return counts.groupBy("column_name").agg(
        F.min_by("v", F.struct((-F.col("n")).alias("n"), "v")).alias("mode"), F.max("n").alias("mode_count"))


def counted_modes(df: DataFrame, columns: Sequence[str], most: dict[str, int] | None = None) -> DataFrame:
    """Modes by counting every value's 128-bit hash; ``most`` passes on counts that are known."""
    keys = lambda c: [k.alias(n) for k, n in zip(value_key(c), "ab")]
    counts = _long(df, columns, keys).groupBy("column_name", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    if most is None:
        top = counts.groupBy("column_name").agg(F.max("n").alias("most"))
        ties = counts.join(top, "column_name").filter("n = most")
    else:
        known = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(most[c]))])
        ties = counts.filter(F.col("n") == known[F.col("column_name")])
    # stored, so that the plan knows their size: few ties go to the rows, not all rows to the ties
    ties = reliable_checkpoint(ties)
    cells = _long(df, columns, lambda c: [*keys(c), _text(c)])
    return cells.join(ties, ["column_name", "a", "b"]).groupBy("column_name").agg(
        F.min("v").alias("mode"), F.max("n").alias("mode_count"))
