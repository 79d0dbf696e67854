"""Data-quality checks (Q1–Q23, Q26, Q27) and the check runner.

Contract: a check returns the *failing rows* as a DataFrame; empty = pass.
Aggregate checks (percentages, min/max, quantiles, counts) return at most
one row holding the measured values. Every check is lazy; the runner
executes them, records a results table and stores the failing rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeflow.functions.columns import (any_null, as_timestamp, count_when, full_match,
                                         try_parse_boolean, try_parse_double)
from lodgeflow.operators.load import schema_diff_fields
from lodgeflow.operators.quantiles import approx_percentiles, exact_percentiles
from lodgeflow.session import delete_path
from lodgeflow.sources.raw import month_calendar



# --- generic column checks -----------------------------------------------------
def unique(df: DataFrame, col: str) -> DataFrame:
    """Q1: values that occur more than once (NULLs ignored)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1)
            .select(F.col(col).alias("unique_field"), "n_records"))


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Q2: rows where ``col`` is NULL."""
    return df.filter(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Q3: values outside the list, with their counts (NULL passes)."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
            .groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
            .select(F.col(col).alias("value_field"), "n_records"))


def relationships(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    # an anti join needs no distinct parent keys, and an aggregate between the
    # exchange and the join would keep AQE from splitting a hot key
    keys = parent.select(F.col(parent_col).alias("__parent_key"))
    return (child.filter(F.col(col).isNotNull())
            .join(keys, F.col(col) == F.col("__parent_key"), "left_anti"))


def positive_value(df: DataFrame, col: str) -> DataFrame:
    """Q5: rows with ``col < 1`` (NULL passes)."""
    return df.filter(F.col(col) < 1)


def _share_check(df: DataFrame, pred: Column, percent: float) -> DataFrame:
    """One pass: total and matching counts; fails if matching > percent % of total."""
    counts = df.agg(F.count(F.lit(1)).alias("total_count"),
                    F.coalesce(count_when(pred), F.lit(0)).alias("zero_count"))
    # in decimals: a share of exactly the limit passes
    return counts.filter(F.col("zero_count") * 100 > F.lit(Decimal(str(percent))) * F.col("total_count"))


def null_percentage(df: DataFrame, cols: str | Sequence[str], percent: float) -> DataFrame:
    """Q6 / Q8: fails when rows with *all* of ``cols`` NULL exceed ``percent`` %."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    pred = F.lit(True)
    for c in cols:
        pred = pred & F.col(c).isNull()
    return _share_check(df, pred, percent)


def value_percentage(df: DataFrame, col: str, value, percent: float) -> DataFrame:
    """Q7: fails when rows with ``col = value`` exceed ``percent`` %."""
    return _share_check(df, F.col(col) == F.lit(value), percent)


def parseable_positive(df: DataFrame, col: str, strip: str = "$") -> DataFrame:
    """Q9: text that does not parse to a number ≥ 0 (NULL input fails)."""
    v = try_parse_double(F.replace(F.col(col), F.lit(strip)))
    return df.filter(v.isNull() | (v < 0))


def parseable_boolean(df: DataFrame, col: str) -> DataFrame:
    """Q10: text that does not parse to a boolean (NULL input passes)."""
    return df.filter(try_parse_boolean(col).isNull() & F.col(col).isNotNull())


def no_nulls(df: DataFrame) -> DataFrame:
    """Rows with a NULL in any column."""
    return df.filter(any_null(df.columns))


def missing_months(series: DataFrame, month_col: str, source: DataFrame,
                   date_col: str) -> DataFrame:
    """Q13: months between the source's first and last month absent from the series."""
    m = F.trunc(F.to_date(F.col(date_col)), "month")
    bounds = source.agg(F.min(m).alias("min_month"), F.max(m).alias("max_month"))
    expected = month_calendar(bounds, out="listing_month")
    actual = series.select(F.col(month_col).alias("listing_month")).distinct()
    return expected.join(actual, "listing_month", "left_anti")


def created_after_review(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews dated on or before their listing's creation."""
    return (listings.join(reviews, "listing_id", "inner")
            .filter(F.col("created_at") >= F.col("review_date")))


def sample_failures(df: DataFrame, pred: Column, n: int = 10,
                    order_by: Sequence[str] | None = None) -> DataFrame:
    """Up to ``n`` failing rows, sorted first so the sample is stable."""
    failing = df.filter(pred)
    if order_by:
        failing = failing.orderBy(*order_by)
    return failing.limit(n)


def between(df: DataFrame, col: str, min_value=None, max_value=None,
            strictly: bool = False) -> DataFrame:
    """Q16: rows outside [min, max] (NULL passes)."""
    c = F.col(col)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | ((c <= min_value) if strictly else (c < min_value))
    if max_value is not None:
        bad = bad | ((c >= max_value) if strictly else (c > max_value))
    return df.filter(bad)


def agg_between(df: DataFrame, col: str, fn: str, min_value=None, max_value=None,
                strictly: bool = False) -> DataFrame:
    """Q17: the column's min or max outside the range (one row when failing)."""
    agg = {"min": F.min, "max": F.max}[fn](F.col(col)).alias(f"{fn}_value")
    return between(df.agg(agg), f"{fn}_value", min_value, max_value, strictly)


def quantile_between(df: DataFrame, col: str, quantile: float, min_value=None,
                     max_value=None, approx: bool = False) -> DataFrame:
    """Q18: continuous quantile outside the range (one row when failing).
    Exact by default (parallel exact percentile); ``approx`` uses a sketch."""
    base = df.select(F.lit(0).alias("__all"), F.col(col))
    q = (approx_percentiles(base, "__all", col, [quantile], prefix="quantile_value") if approx
         else exact_percentiles(base, "__all", col, None, [quantile], prefix="quantile_value"))
    return between(q.select(F.col("quantile_value0").alias("quantile_value")), "quantile_value",
                   min_value, max_value)


def freshness(df: DataFrame, ts_col: str, as_of=None, warn_after_hours: float = 1,
              error_after_hours: float = 24) -> DataFrame:
    """Q19: elapsed time since the newest row, in hours; one row per check.

    ``status`` is ``pass``, ``warn`` or ``error``; the check fails (returns
    its row) unless it passes.
    """
    latest = df.agg(F.max(ts_col).alias("max_loaded_at"))
    seconds = F.timestamp_diff("SECOND", F.col("max_loaded_at").cast("timestamp_ntz"), as_timestamp(as_of))
    age = seconds / F.lit(3600.0)
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
               .when(age > error_after_hours, F.lit("error"))
               .when(age > warn_after_hours, F.lit("warn"))
               .otherwise(F.lit("pass")))
    return (latest.select("max_loaded_at", age.alias("hours_since_load"), status.alias("status"))
            .filter(F.col("status") != "pass"))


def distinct_count_equals(df: DataFrame, col: str, value: int) -> DataFrame:
    """Q20: distinct non-NULL count differs from ``value``."""
    return (df.agg(F.count_distinct(F.col(col)).alias("distinct_count"))
            .filter(F.col("distinct_count") != value))


def row_count_equals(df: DataFrame, other: DataFrame) -> DataFrame:
    """Q21: both row counts when they differ. Two scalar subqueries, no join."""
    a = df.select(F.count(F.lit(1))).scalar()
    b = other.select(F.count(F.lit(1))).scalar()
    one = df.sparkSession.range(1)
    return (one.select(a.alias("row_count"), b.alias("other_row_count"))
            .filter(F.col("row_count") != F.col("other_row_count")))


def matches_regex(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Q23: non-NULL values whose whole text does not match ``pattern``."""
    return df.filter(F.col(col).isNotNull() & ~full_match(col, pattern))


# --- schema checks (Q22, Q26, Q27) ------------------------------------------------
_FAMILIES: dict[str, Callable[[T.DataType], bool]] = {
    "number": lambda t: isinstance(t, (T.IntegralType, T.DecimalType, T.FractionalType)),
    "integer": lambda t: isinstance(t, T.IntegralType),
    "float": lambda t: isinstance(t, (T.FloatType, T.DoubleType)),
    "decimal": lambda t: isinstance(t, T.DecimalType),
    "varchar": lambda t: isinstance(t, (T.StringType, T.VarcharType, T.CharType)),
    "string": lambda t: isinstance(t, (T.StringType, T.VarcharType, T.CharType)),
    "text": lambda t: isinstance(t, (T.StringType, T.VarcharType, T.CharType)),
    "date": lambda t: isinstance(t, T.DateType),
    "timestamp": lambda t: isinstance(t, (T.TimestampType, T.TimestampNTZType)),
    "timestamp_ntz": lambda t: isinstance(t, T.TimestampNTZType),
    "boolean": lambda t: isinstance(t, T.BooleanType),
}

SCHEMA_CHANGE_SCHEMA = T.StructType([
    T.StructField("change", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("old_type", T.StringType()),
    T.StructField("new_type", T.StringType()),
])


def of_type(df: DataFrame, col: str, family: str) -> DataFrame:
    """Q22: one row (column, expected, actual) when the type is not in ``family``."""
    actual = df.schema[col].dataType
    ok = _FAMILIES[family.lower()](actual)
    rows = [] if ok else [(col, family, actual.simpleString())]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, expected_type string, actual_type string")


def schema_changes(spark: SparkSession, previous: T.StructType, current: T.StructType) -> DataFrame:
    """Q26: columns added, removed or retyped since the previous run."""
    return spark.createDataFrame(schema_diff_fields(previous, current), SCHEMA_CHANGE_SCHEMA)


def schema_snapshot(df: DataFrame, table_name: str) -> DataFrame:
    """(table_name, column_name, data_type, ordinal) — store it after each run
    so the next run can be compared with ``schema_changes_since``."""
    rows = [(table_name, f.name, f.dataType.simpleString(), i)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "table_name string, column_name string, data_type string, ordinal int")


def schema_changes_since(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Q26 over stored snapshots: a full outer join on (table, column)."""
    p, c = previous.alias("p"), current.alias("c")
    j = p.join(c, (F.col("p.table_name") == F.col("c.table_name"))
               & (F.lower(F.col("p.column_name")) == F.lower(F.col("c.column_name"))), "full_outer")
    change = (F.when(F.col("p.column_name").isNull(), "column_added")
               .when(F.col("c.column_name").isNull(), "column_removed")
               .when(F.col("p.data_type") != F.col("c.data_type"), "type_changed"))
    return j.select(F.coalesce("c.table_name", "p.table_name").alias("table_name"),
                    change.alias("change"),
                    F.coalesce("c.column_name", "p.column_name").alias("column_name"),
                    F.col("p.data_type").alias("old_type"), F.col("c.data_type").alias("new_type")) \
            .filter(F.col("change").isNotNull())


def schema_vs_baseline(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Q27: differences between a table and its declared baseline schema."""
    return schema_changes(df.sparkSession, declared, df.schema)


# --- runner (W9) ---------------------------------------------------------------------
class CheckError(RuntimeError):
    """Raised when checks of severity ``error`` fail and the caller wants to stop."""


@dataclass
class Check:
    name: str
    build: Callable[[], DataFrame]
    severity: str = "error"          # "warn" or "error"
    model: str = ""
    tags: tuple[str, ...] = field(default_factory=tuple)
    #: Row-level checks: the predicate of failing rows and the table it reads.
    failing: Column | None = None
    frame: Callable[[], DataFrame] | None = None


RESULT_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("failures", T.LongType()),
    T.StructField("status", T.StringType()),
])


def _counts(suite: Sequence[Check]) -> DataFrame | None:
    """check_name, failures: the row-level checks of a table in one aggregate, each
    other check as a one-row aggregate."""
    parts, by_table = [], {}
    for c in suite:
        if c.failing is not None and c.frame is not None:
            by_table.setdefault(c.model, []).append(c)
        else:
            parts.append(c.build().agg(F.count(F.lit(1)).alias("failures"))
                         .select(F.lit(c.name).alias("check_name"), "failures"))
    for members in by_table.values():
        one = members[0].frame().agg(*[F.count(F.when(c.failing, 1)).alias(f"f{i}") for i, c in enumerate(members)])
        parts.append(one.select(F.explode(F.array(*[
            F.struct(F.lit(c.name).alias("check_name"), F.col(f"f{i}").alias("failures"))
            for i, c in enumerate(members)])).alias("r")).select("r.*"))
    counts = parts[0] if parts else None
    for p in parts[1:]:
        counts = counts.unionByName(p)
    return counts


def run_checks(spark: SparkSession, suite: Sequence[Check], failures_path: str | None = None,
               results_path: str | None = None, invocation_id: str | None = None,
               stop_on_error: bool = False) -> DataFrame:
    """Run every check; return (check_name, model, severity, failures, status).

    Row-level checks share one scan per table and all counts come from one Spark
    job. With ``failures_path`` the failing rows of each failed check are stored
    under ``<failures_path>/<check_name>``, and what an earlier run left there for a
    check that passes now is removed. ``results_path`` gets this run's rows
    appended with the invocation and the time. ``stop_on_error`` raises
    ``CheckError`` after all that when a check of severity ``error`` failed.
    """
    counts = _counts(suite)
    if counts is None:
        return spark.createDataFrame([], RESULT_SCHEMA)
    about = spark.createDataFrame([(c.name, c.model, c.severity) for c in suite],
                                  "check_name string, model string, severity string")
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
               .when(F.col("severity") == "warn", F.lit("warn"))
               .otherwise(F.lit("fail")))
    results = about.join(counts, "check_name").select(
        "check_name", "model", "severity", "failures", status.alias("status"))
    if not (failures_path or results_path or stop_on_error):
        return results
    # one row per check: bounded by the suite, so it is fine on the driver
    rows = results.collect()
    done = spark.createDataFrame(rows, RESULT_SCHEMA)
    if results_path:
        (done.withColumns({"invocation_id": F.lit(invocation_id or uuid.uuid4().hex), "run_at": F.localtimestamp()})
         .coalesce(1).write.mode("append").parquet(results_path))
    failed = {r.check_name for r in rows if r.failures > 0}
    if failures_path:
        for c in suite:
            if c.name in failed:
                c.build().write.mode("overwrite").parquet(f"{failures_path}/{c.name}")
            else:
                delete_path(spark, f"{failures_path}/{c.name}")
    errors = sorted(r.check_name for r in rows if r.status == "fail")
    if stop_on_error and errors:
        raise CheckError(f"{len(errors)} checks failed: {', '.join(errors)}")
    return done
