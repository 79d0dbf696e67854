"""Mergeable profiles per partition (PR1b, PR1i, A8): a daily profile reads new partitions only.

``profile_new_partitions`` profiles the partitions of a table that the store does not hold
(or that are named as changed) and appends a row per partition and column: counts, bounds in
the columns' own types, lengths, patterns, exact sums and a distinct-count sketch of the
values' hashes. Rows are fixed in width whatever a partition holds, and merge.

``merged_profile`` merges the newest row of every partition to the profile of the whole
table. Counts, bounds, lengths, patterns and sums are exact. A distinct count is an estimate
with bounds of ``SIGMAS`` standard errors; the class that the profile gives a column
(UNIQUE, CONSTANT, LOW, MEDIUM, HIGH) is exact: where both bounds agree on it they decide,
a column with equal least and greatest value is constant, and only a column whose bounds
straddle a limit is counted exactly, in the table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeflow.functions.columns import full_match, safe_divide
from lodgeflow.operators.profile import (ALPHA_PATTERN, LOW_CARDINALITY_MAX, MEDIUM_CARDINALITY_MAX, NUMERIC_PATTERN,
                                         _q, cardinality, column_families, distinct_counts)
from lodgeflow.session import path_exists

#: log2 of the sketch's buckets, its relative standard error when merged, and the
#: standard errors between an estimate and its bounds.
SKETCH_BITS = 14
STANDARD_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
SIGMAS = 4


def _column_state(name: str, family: str, kind: T.DataType) -> Column:
    """The mergeable state of one column as a struct (of one type for all columns)."""
    c = _q(name)
    none = lambda t="bigint": F.lit(None).cast(t)
    ordered = family in ("string", "numeric", "temporal")
    text, flag = family == "string", family == "boolean"
    value = c.cast("string") if family == "other" else c
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        total = F.sum(c.cast("decimal(38,6)") if isinstance(kind, T.DecimalType) else c.cast("decimal(20,0)"))
    else:
        total = none("decimal(38,6)")
    said = {
        "filled": F.count(c),
        "min_length": F.min(F.length(c)).cast("bigint") if text else none(),
        "max_length": F.max(F.length(c)).cast("bigint") if text else none(),
        "length": F.sum(F.length(c)).cast("bigint") if text else none(),
        "empty": F.count_if(c == "") if text else none(),
        "blank": F.count_if((F.trim(c) == "") & (c != "")) if text else none(),
        "digits": F.count_if(full_match(c, NUMERIC_PATTERN)) if text else none(),
        "letters": F.count_if(full_match(c, ALPHA_PATTERN)) if text else none(),
        "true": F.count_if(c) if flag else none(), "false": F.count_if(~c) if flag else none(),
        "least": F.min(c).cast("string") if ordered else none("string"),
        "greatest": F.max(c).cast("string") if ordered else none("string"),
        "total": total.cast("decimal(38,6)"),
        "sketch": F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(value)), F.lit(SKETCH_BITS)),
    }
    return F.struct(F.lit(name).alias("column_name"), F.lit(family).alias("family"),
                    F.lit(kind.simpleString()).alias("type"), *[x.alias(k) for k, x in said.items()])


def stored_partitions(spark: SparkSession, path: str) -> list:
    """Partitions the store holds: as many as the table has."""
    if not path_exists(spark, path):
        return []
    return [r["part"] for r in spark.read.parquet(path).select("part").distinct().collect()]


def profile_new_partitions(spark: SparkSession, path: str, table: DataFrame, partition: str, run: str,
                           changed: Sequence = ()) -> list[str]:
    """Appends the state of the partitions that the store at ``path`` lacks, and of those in
    ``changed``; returns them (as text). ``partition`` is the table's partition column: the
    read is filtered by literal values, so only their files are opened. ``run`` names the
    run; the last run that saw a partition counts (runs sort by name)."""
    of_table = [r[0] for r in table.select(_q(partition)).distinct().collect()]  # one row per partition
    known = set(stored_partitions(spark, path)) - {str(c) for c in changed}
    new = [p for p in of_table if _name(p) not in known]
    if not new:
        return []
    values = [p for p in new if p is not None]
    wanted = _q(partition).isin(values) if values else F.lit(False)
    if None in new:
        wanted = wanted | _q(partition).isNull()
    cols = [(n, f) for n, f in column_families(table, [partition])]
    states = F.array(*[_column_state(n, f, table.schema[n].dataType) for n, f in cols])
    rows = table.filter(wanted).groupBy(_q(partition).alias("p")).agg(F.count(F.lit(1)).alias("rows"), states.alias("s"))
    part = F.coalesce(F.col("p").cast("string"), F.lit("NULL"))
    (rows.select(part.alias("part"), F.lit(run).alias("run"), "rows", F.explode("s").alias("e"))
     .select("part", "run", "rows", "e.*").write.mode("append").parquet(path))
    return sorted(_name(p) for p in new)


def _name(value) -> str:
    return "NULL" if value is None else str(value)


def _newest(states: DataFrame) -> DataFrame:
    latest = Window.partitionBy("part", "column_name").orderBy(F.desc("run"))
    return states.withColumn("turn", F.row_number().over(latest)).filter("turn = 1").drop("turn")


def _typed_bounds(states: DataFrame) -> DataFrame:
    """column_name, min_exact, max_exact: texts compared as values of the column's type."""
    kinds = [(r["column_name"], r["type"]) for r in
             states.filter("least IS NOT NULL").select("column_name", "type").distinct().collect()]  # one per column
    parts = []
    for name, kind in kinds:
        lo, hi = F.min(F.col("least").cast(kind)), F.max(F.col("greatest").cast(kind))
        parts.append(states.filter((F.col("column_name") == name) & (F.col("type") == kind)).agg(
            F.lit(name).alias("column_name"), lo.cast("string").alias("min_exact"), hi.cast("string").alias("max_exact")))
    if not parts:
        return states.select("column_name", F.col("least").alias("min_exact"), F.col("greatest").alias("max_exact")).limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _class_of(distinct: Column) -> Column:
    return (F.when(distinct <= LOW_CARDINALITY_MAX, "LOW_CARDINALITY")
            .when(distinct <= MEDIUM_CARDINALITY_MAX, "MEDIUM_CARDINALITY").otherwise("HIGH_CARDINALITY"))


def merged_profile(spark: SparkSession, path: str, table: DataFrame | None = None) -> DataFrame:
    """One row per column of the table that the store's partitions make up. Columns whose class
    the bounds leave open are counted in ``table`` (class and ``distinct_count`` are NULL
    without it); ``distinct_count`` is filled where it is known exactly."""
    states = _newest(spark.read.parquet(path))
    sums = ["rows", "filled", "length", "empty", "blank", "digits", "letters", "true", "false", "total"]
    merged = states.groupBy("column_name").agg(
        F.first("family").alias("family"), *[F.sum(c).alias(c) for c in sums],
        F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"))
    merged = merged.join(_typed_bounds(states), "column_name", "left")
    margin = F.lit(SIGMAS * STANDARD_ERROR)
    estimate, filled = F.col("distinct_estimate"), F.col("filled")
    low = F.least(F.floor(estimate * (1 - margin)), filled).cast("bigint")
    high = F.least(F.ceil(estimate * (1 + margin)), filled).cast("bigint")
    constant = F.coalesce(F.col("min_exact") == F.col("max_exact"), F.lit(False))
    flags = (F.col("true") > 0).cast("bigint") + (F.col("false") > 0).cast("bigint")
    # what needs no estimate: no value, one value, the values of a boolean column
    plain = F.when(filled == 0, F.lit(0)).when(constant, F.lit(1)).when(F.col("family") == "boolean", flags).cast("bigint")
    merged = merged.withColumn("plain", plain).withColumns(
        {"distinct_low": F.coalesce("plain", low), "distinct_high": F.coalesce("plain", high)})
    lo, hi = F.col("distinct_low"), F.col("distinct_high")
    # a unique column has no NULL and as many values as rows
    certain = F.col("plain").isNotNull() | (
        (lo > 1) & (_class_of(lo) == _class_of(hi)) & ((hi < F.col("rows")) | (filled < F.col("rows"))))
    merged = merged.withColumn("certain", certain)
    open_columns = [r["column_name"] for r in merged.filter("NOT certain").select("column_name").collect()]
    exact = _recounted(spark, table, open_columns)
    total = F.col("rows")
    known = F.coalesce("recounted", "plain")
    kind = F.when(known.isNotNull(), cardinality(known, total)).when(F.col("certain"), _class_of(lo))
    return merged.join(exact, "column_name", "left").select(
        "column_name", "family", total.alias("total_rows"), (total - filled).alias("null_count"),
        F.round(safe_divide(filled * 100.0, total), 2).alias("completeness_rate"),
        kind.alias("cardinality_category"), known.alias("distinct_count"),
        "distinct_estimate", "distinct_low", "distinct_high", "min_exact", "max_exact",
        "min_length", "max_length", safe_divide(F.col("length").cast("double"), filled).alias("avg_length"),
        F.col("empty").alias("empty_count"), F.col("blank").alias("whitespace_only_count"),
        F.col("digits").alias("numeric_pattern_count"), F.col("letters").alias("alpha_pattern_count"),
        safe_divide(F.col("total").cast("double"), filled).alias("avg"),
        F.col("true").alias("true_count"), F.col("false").alias("false_count"))


def _recounted(spark: SparkSession, table: DataFrame | None, columns: list[str]) -> DataFrame:
    """column_name, recounted: exact distinct counts of a few columns."""
    if table is None or not columns:
        return spark.createDataFrame([], "column_name string, recounted bigint")
    families = dict(column_families(table))
    counts = distinct_counts(table, [(c, "other" if families[c] == "other" else "plain") for c in columns], False)
    return spark.createDataFrame([(c, counts[c]) for c in columns], "column_name string, recounted bigint")
