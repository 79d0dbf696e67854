"""Table profiler (PR1a–PR1m) and sampling.

Nothing is turned into text and no value is shuffled for what an aggregate can
say where the rows lie:

* one native aggregate over the table gives counts, bounds in the columns' own
  types, lengths, patterns and sums: a row per task;
* distinct counts, and the greatest count of a value, shuffle 128-bit keys of fixed
  width, each value once per task, a column at a time; the mode's text is then looked up
  by its hash;
* percentiles refine histograms in place (``operators.quantiles``), per type, so
  whole numbers beyond 2^53 and decimals stay exact;
* outliers take one more aggregate with the mean and deviation known.

``profile_frame`` is the long per-column result; ``profile_table`` pivots it
to the reference's one-wide-row-per-run shape with one more aggregate over
that small frame, and ``merge_profile_history`` appends runs incrementally
(W7 → W6 → W4). ``operators.profile_store`` keeps mergeable profiles per partition.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeflow.functions.columns import (as_timestamp, full_match, hour_diff, row_text,
                                         safe_divide, truncate_period)
from lodgeflow.operators.frequent import counted_modes, value_key
from lodgeflow.operators.load import skip_existing, write_table
from lodgeflow.operators.quantiles import exact_percentiles
from lodgeflow.session import path_exists, reliable_checkpoint

ROW_KEY = "#row"
# The profiler's text patterns and thresholds.
NUMERIC_PATTERN = "^[0-9]+$"
ALPHA_PATTERN = r"^[A-Za-z\s]+$"
OUTLIER_SIGMAS = 3
LOW_CARDINALITY_MAX = 10
MEDIUM_CARDINALITY_MAX = 100
PERCENTILES = (0.25, 0.5, 0.75)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def column_families(df: DataFrame, exclude: Sequence[str] = ()) -> list[tuple[str, str]]:
    """(column, family) after case-insensitive exclusion; family is one of
    boolean, temporal, string, numeric, other — dispatched on the Spark type."""
    ex = {c.lower() for c in exclude}
    out = []
    for f in df.schema.fields:
        if f.name.lower() in ex:
            continue
        t = f.dataType
        if isinstance(t, T.BooleanType):
            fam = "boolean"
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            fam = "temporal"
        elif isinstance(t, (T.StringType, T.VarcharType, T.CharType)):
            fam = "string"
        elif isinstance(t, T.NumericType):
            fam = "numeric"
        else:
            fam = "other"
        out.append((f.name, fam))
    return out


# --- S4 -------------------------------------------------------------------------
def sample_rows(df: DataFrame, pct: float, seed: int = 42, method: str = "bernoulli",
                key: str | None = None) -> DataFrame:
    """Row sample of ``pct`` percent.

    ``bernoulli``: ``df.sample`` — deterministic for a fixed seed over the
    same input, so every pass of the profiler sees the same rows.
    ``hash``: keep rows whose md5(key) falls below the threshold; stable
    across engines and runs (the checkable form).
    """
    if method == "bernoulli":
        return df.sample(withReplacement=False, fraction=pct / 100.0, seed=seed)
    if method == "hash":
        if key is None:
            raise ValueError("hash sampling needs a key column")
        threshold = format(int(round(pct / 100.0 * 16 ** 8)), "08x")
        return df.filter(F.substring(F.md5(_q(key).cast("string")), 1, 8) < F.lit(threshold))
    raise ValueError(f"unknown sampling method {method!r}")


# --- one aggregate over the table ---------------------------------------------------
def column_aggs(i: int, name: str, family: str) -> list[Column]:
    """What one pass can say about column ``i``: fixed-width partial results."""
    c = _q(name)
    said = {"filled": F.count(c)}
    if family == "string":
        said |= {"min_length": F.min(F.length(c)), "max_length": F.max(F.length(c)),
                 "length": F.sum(F.length(c).cast("bigint")),
                 "empty": F.count_if(c == ""), "blank": F.count_if((F.trim(c) == "") & (c != "")),
                 "digits": F.count_if(full_match(c, NUMERIC_PATTERN)), "letters": F.count_if(full_match(c, ALPHA_PATTERN))}
    elif family == "boolean":
        said |= {"true": F.count_if(c), "false": F.count_if(~c)}
    elif family in ("numeric", "temporal"):
        said |= {"min": F.min(c).cast("string"), "max": F.max(c).cast("string")}
    return [x.alias(f"{k}{i}") for k, x in said.items()]


def _moment_aggs(i: int, name: str, kind: T.DataType) -> list[Column]:
    """Mean (of an exact sum, but for floating point) and sample variance."""
    c = _q(name)
    whole = c.cast("decimal(20,0)") if isinstance(kind, T.IntegralType) else c
    mean = F.avg(c) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.sum(whole).cast("double") / F.count(c)
    return [mean.alias(f"avg{i}"), F.var_samp(c.cast("double")).alias(f"variance{i}")]


def value_tops(df: DataFrame, cols: Sequence[tuple[str, str]], row_hash: bool) -> dict:
    """Per column, per date column's days (``(name, "day")``) and for rows (``ROW_KEY``), by
    128-bit keys (``_halves``): ``distinct`` non-NULL values, the greatest count ``most`` of one,
    how many values ``tie`` at it and the key (``a``, ``b``) of one of these.

    Each has a scan of its own that reads only its columns, and one shuffle for all: a task
    gathers the values of one column and one split, so it holds them without spilling."""
    keys: list = []
    parts = []

    def add(key, halves: list[Column], there: Column) -> None:
        parts.append(df.filter(there).select(F.lit(len(keys)).alias("k"), *halves))
        keys.append(key)

    for name, fam in cols:
        c = _q(name)
        add(name, _halves(c.cast("string") if fam == "other" else c, df.schema[name].dataType), c.isNotNull())
        if fam == "temporal":
            add((name, "day"), _halves(F.to_date(c)), c.isNotNull())
    if row_hash:
        add(ROW_KEY, _halves(row_text([_q(n) for n, _ in cols])), F.lit(True))
    counts = reduce(DataFrame.unionByName, parts).groupBy("k", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    # (a, b) is one value's where nothing ties; fixed-width aggregates, so nothing is sorted
    by_count = counts.groupBy("k", "n").agg(F.count(F.lit(1)).alias("tie"), F.min("a").alias("a"), F.min("b").alias("b"))
    tops = by_count.groupBy("k").agg(F.sum("tie").alias("distinct"), F.max(F.struct("n", "tie", "a", "b")).alias("top"))
    found = {r["k"]: (r["distinct"], r["top"]["n"], r["top"]["tie"], r["top"]) for r in tops.collect()}  # one per column
    return {key: found.get(k, (0, 0, 0, None)) for k, key in enumerate(keys)}


def distinct_counts(df: DataFrame, cols: Sequence[tuple[str, str]], row_hash: bool) -> dict:
    return {key: top[0] for key, top in value_tops(df, cols, row_hash).items()}


def _modes(df: DataFrame, strings: list[str], tops: dict) -> dict[str, str]:
    """Most frequent value per text column (ties: the least)."""
    unique = [c for c in strings if tops[c][1] == 1]          # every value ties
    single = [c for c in strings if tops[c][1] > 1 and tops[c][2] == 1]
    tied = [c for c in strings if tops[c][1] > 1 and tops[c][2] > 1]
    aggs = [F.min(_q(c)).alias(c) for c in unique]
    for c in single:
        a, b = value_key(_q(c))
        key = tops[c][3]
        aggs.append(F.min(F.when((a == key["a"]) & (b == key["b"]), _q(c))).alias(c))
    out = df.agg(*aggs).first().asDict() if aggs else {}
    if tied:
        out |= {r["column_name"]: r["mode"] for r in counted_modes(df, tied, {c: tops[c][1] for c in tied}).collect()}
    return out


def _halves(value: Column, kind: T.DataType | None = None) -> list[Column]:
    """128 bits that stand for a value: whole numbers themselves, hashes of others."""
    pair = (value.cast("bigint"), F.lit(0).cast("bigint")) if isinstance(kind, T.IntegralType) else value_key(value)
    return [h.alias(n) for h, n in zip(pair, "ab")]


def _percentiles(df: DataFrame, numeric: list[str]) -> dict[str, tuple]:
    """Exact percentiles per numeric column; columns of one type go together."""
    kinds: dict[str, list[str]] = {}
    for n in numeric:
        t = df.schema[n].dataType
        kinds.setdefault("bigint" if isinstance(t, T.IntegralType) else
                         "double" if isinstance(t, (T.DoubleType, T.FloatType)) else t.simpleString(), []).append(n)
    out = {}
    for kind, names in kinds.items():
        cells = F.array(*[F.struct(F.lit(n).alias("c"), _q(n).cast(kind).alias("x")) for n in names])
        values = df.select(F.explode(cells).alias("e")).select("e.c", "e.x")
        for r in exact_percentiles(values, "c", "x", None, PERCENTILES, stored=True).collect():  # one per column
            out[r["c"]] = (r["q0"], r["q1"], r["q2"])
    return out


# One row per column; what does not apply to a family is NULL.
_FRAME = ("column_name string, family string, total_rows bigint, null_count bigint, distinct_count bigint, "
          "mode string, min_length int, max_length int, avg_length double, empty_count bigint, "
          "whitespace_only_count bigint, numeric_pattern_count bigint, alpha_pattern_count bigint, "
          "min_exact string, max_exact string, avg double, stddev double, variance double, p25 double, median double, "
          "p75 double, outlier_count bigint, distinct_dates bigint, true_count bigint, false_count bigint")


def profile_frame(df: DataFrame, exclude: Sequence[str] = (), numeric: bool = True,
                  approx_percentiles: bool = False, families: Sequence[str] | None = None,
                  row_hash: bool = True, stored: bool = False) -> DataFrame:
    """Every metric of every column (plus, with ``row_hash``, the ``#row``
    pseudo-column), one row per column; only the columns of the wanted
    ``families`` (default: all) are read.

    Eager. The columns are read a few times, so they are stored first unless
    ``stored`` says that ``df`` is a table that is cheap to read again. The
    driver sees one row per column.
    """
    cols = [(n, f) for n, f in column_families(df, exclude) if families is None or f in families]
    if not cols:
        raise ValueError(f"the table has no column of the families {families!r}")
    df = df.select(*[_q(n) for n, _ in cols])
    if not stored:
        df = reliable_checkpoint(df)
    kinds = {n: df.schema[n].dataType for n, _ in cols}
    strings = [n for n, f in cols if f == "string"]
    numbers = [n for n, f in cols if f == "numeric"] if numeric else []
    probs = [float(p) for p in PERCENTILES]
    aggs = [a for i, (n, f) in enumerate(cols) for a in column_aggs(i, n, f)]
    aggs += [a for i, (n, _) in enumerate(cols) if n in numbers for a in _moment_aggs(i, n, kinds[n])]
    if approx_percentiles:
        aggs += [F.percentile_approx(_q(n).cast("double"), probs, 10_000).alias(f"q{i}")
                 for i, (n, _) in enumerate(cols) if n in numbers]
    said = df.agg(F.count(F.lit(1)).alias("rows"), *aggs).first()
    rows = said["rows"]
    tops = value_tops(df, cols, row_hash)
    distinct = {key: top[0] for key, top in tops.items()}
    modes = _modes(df, strings, tops)
    found = {} if approx_percentiles or not numbers else _percentiles(df, numbers)
    at = {n: i for i, (n, _) in enumerate(cols)}

    def outliers(n: str) -> Column:
        mean, variance = said[f"avg{at[n]}"], said[f"variance{at[n]}"]
        if variance is None:  # fewer than two values
            return F.lit(0).cast("bigint")
        return F.count_if(F.abs(_q(n).cast("double") - F.lit(mean)) > F.lit(OUTLIER_SIGMAS * variance ** 0.5))

    outside = df.agg(*[outliers(n).alias(f"o{at[n]}") for n in numbers]).first() if numbers else ()
    out = []
    for i, (n, f) in enumerate(cols):
        say = lambda key, row=said: row[f"{key}{i}"] if f"{key}{i}" in row else None  # noqa: B023, E731
        filled = said[f"filled{i}"]
        variance = say("variance")
        quartiles = found.get(n) or say("q") or (None, None, None)
        out.append((n, f, rows, rows - filled, distinct[n], modes.get(n), say("min_length"), say("max_length"),
                    say("length") / filled if f == "string" and filled else None, say("empty"), say("blank"),
                    say("digits"), say("letters"), say("min"), say("max"), say("avg"),
                    None if variance is None else variance ** 0.5, variance, *quartiles, say("o", outside),
                    distinct.get((n, "day")), say("true"), say("false")))
    if row_hash:
        out.append((ROW_KEY, "row", rows, 0, distinct[ROW_KEY], *[None] * 20))
    return _with_rates(df.sparkSession.createDataFrame(out if rows else [], _FRAME))


def _with_rates(frame: DataFrame) -> DataFrame:
    total, distinct = F.col("total_rows"), F.col("distinct_count")
    of = lambda family, c: F.when(F.col("family") == family, c)
    return frame.select(
        "column_name", "family", "total_rows", "null_count", "distinct_count",
        F.round(safe_divide((total - F.col("null_count")) * 100.0, total), 2).alias("completeness_rate"),
        F.round(safe_divide(distinct * 100.0, total), 2).alias("uniqueness_rate"),
        cardinality(distinct, total).alias("cardinality_category"),
        "mode", "min_length", "max_length", "avg_length", "empty_count", "whitespace_only_count",
        "numeric_pattern_count", "alpha_pattern_count",
        of("numeric", F.col("min_exact")).cast("double").alias("min"),
        of("numeric", F.col("max_exact")).cast("double").alias("max"),
        "avg", "stddev", "variance", "p25", "median", "p75", "outlier_count",
        of("temporal", F.col("min_exact")).cast("timestamp_ntz").alias("earliest"),
        of("temporal", F.col("max_exact")).cast("timestamp_ntz").alias("latest"),
        "distinct_dates", "true_count", "false_count", "min_exact", "max_exact")


def cardinality(distinct: Column, total: Column) -> Column:
    """X-rule of the profile: the class of a column by its distinct values."""
    return (F.when(distinct == total, "UNIQUE").when(distinct == 1, "CONSTANT")
            .when(distinct <= LOW_CARDINALITY_MAX, "LOW_CARDINALITY")
            .when(distinct <= MEDIUM_CARDINALITY_MAX, "MEDIUM_CARDINALITY")
            .otherwise("HIGH_CARDINALITY"))


def column_profile(df: DataFrame, exclude: Sequence[str] = (),
                   advanced: bool = True, numeric: bool = True,
                   approx_percentiles: bool = False, families: Sequence[str] | None = None,
                   stored: bool = False) -> DataFrame:
    """One row per profiled column with every metric that applies to it
    (``numeric=False`` skips moments, percentiles and outliers; ``families``
    limits the scan to the columns of some families). Whole rows are not hashed.
    ``min_exact`` and ``max_exact`` are the bounds as text, in the column's own type."""
    res = profile_frame(df, exclude, numeric, approx_percentiles, families, row_hash=False, stored=stored)
    if not advanced:
        res = res.select("column_name", "family", "total_rows", "null_count", "distinct_count",
                         "min_length", "max_length", "avg_length", "min", "max", "avg",
                         "earliest", "latest", "true_count", "false_count")
    return res


def _table_aggs(df: DataFrame, cols: list[tuple[str, str]], date_col: str | None,
                as_of, freshness_hours: float, advanced: bool = True) -> list[Column]:
    """Aggregates over ``profile_frame`` giving the table-level metrics with
    the columns' own types restored."""
    def pick(name: str, metric: str) -> Column:
        return F.max(F.when(F.col("column_name") == name, F.col(metric)))

    total = F.coalesce(pick(ROW_KEY, "total_rows"), F.lit(0))          # empty table: 0 rows
    distinct = F.coalesce(pick(ROW_KEY, "distinct_count"), F.lit(0))
    aggs = [total.alias("total_rows"), distinct.alias("distinct_rows"),
            F.round(safe_divide((total - distinct) * 100.0, total), 2).alias("duplicate_rate")]
    types = {f.name: f.dataType for f in df.schema.fields}
    for n, f in cols:
        if f == "temporal":
            lo = pick(n, "earliest").cast(types[n])
            hi = pick(n, "latest").cast(types[n])
            aggs += [lo.alias(f"{n}_earliest"), hi.alias(f"{n}_latest")]
            if advanced:
                days = pick(n, "distinct_dates")
                aggs += [F.datediff(F.to_date(hi), F.to_date(lo)).alias(f"{n}_date_range_days"),
                         days.alias(f"{n}_distinct_dates"),
                         F.round(safe_divide(total, days), 2).alias(f"{n}_records_per_day_avg")]
        elif f == "boolean":
            aggs += [pick(n, "true_count").alias(f"{n}_true_count"),
                     pick(n, "false_count").alias(f"{n}_false_count")]
    if date_col:
        latest = pick(date_col, "latest").cast(types[date_col])
        hours = hour_diff(latest, as_timestamp(as_of))
        aggs += [hours.alias("hours_since_update"),
                 F.when(hours > freshness_hours, "STALE").otherwise("FRESH").alias("freshness_status"),
                 latest.alias("latest_record_date")]
    else:
        aggs += [F.lit(None).cast("bigint").alias("hours_since_update"),
                 F.lit(None).cast("string").alias("freshness_status"),
                 F.lit(None).cast("timestamp_ntz").alias("latest_record_date")]
    return aggs


def table_metrics(df: DataFrame, exclude: Sequence[str] = (), date_col: str | None = None,
                  as_of=None, freshness_hours: float = 24, stored: bool = False) -> DataFrame:
    """One row: totals, whole-row distinct count and duplicate rate, typed
    earliest/latest per date column, true/false counts per boolean column,
    freshness — from the column metrics."""
    cols = column_families(df, exclude)
    frame = profile_frame(df, exclude, numeric=False, stored=stored)
    return frame.agg(*_table_aggs(df, cols, date_col, as_of, freshness_hours))



# --- wide row (PR1a–PR1k) --------------------------------------------------------
WIDE_METRICS = {
    "boolean": (),
    "temporal": (),
    "string": ("min_length", "max_length", "avg_length", "mode", "empty_count",
               "whitespace_only_count", "numeric_pattern_count", "alpha_pattern_count"),
    "numeric": ("min", "max", "avg", "stddev", "variance", "p25", "median", "p75",
                "outlier_count"),
    "other": (),
}
BASIC_METRICS = ("min_length", "max_length", "avg_length", "min", "max", "avg")
QUALITY_METRICS = ("completeness_rate", "uniqueness_rate", "cardinality_category")
UNIVERSAL_METRICS = ("null_count", "distinct_count")


def profile_table(df: DataFrame, model_name: str, sample_pct: float | None = None,
                  advanced: bool = True, exclude: Sequence[str] = (),
                  freshness_hours: float = 24, date_col: str | None = None,
                  frequency: str = "daily", as_of=None, env: str = "dev",
                  sample_seed: int = 42, approx_percentiles: bool = False, stored: bool = False) -> DataFrame:
    """One wide row per run: header, row metrics, ``<col>_<metric>`` columns
    (bounds of numbers in the column's own type), freshness and a change hash —
    one aggregate over the per-column frame (a row per column)."""
    base = sample_rows(df, sample_pct, sample_seed) if sample_pct else df
    cols = column_families(base, exclude)
    frame = profile_frame(base, exclude, approx_percentiles=approx_percentiles, stored=stored)
    aggs = _table_aggs(base, cols, date_col, as_of, freshness_hours, advanced)
    hash_parts = [F.col("total_rows"), F.col("distinct_rows")]
    for n, f in cols:
        metrics = WIDE_METRICS[f] if advanced else tuple(m for m in WIDE_METRICS[f] if m in BASIC_METRICS)
        metrics = metrics + (QUALITY_METRICS if advanced else ()) + UNIVERSAL_METRICS
        own = {"min": "min_exact", "max": "max_exact"} if f == "numeric" else {}
        for m in metrics:
            value = F.max(F.when(F.col("column_name") == n, F.col(own.get(m, m))))
            aggs.append((value.cast(base.schema[n].dataType) if m in own else value).alias(f"{n}_{m}"))
        hash_parts += [F.col(f"{n}_null_count"), F.col(f"{n}_distinct_count")]
    wide = frame.agg(*aggs)
    now = as_timestamp(as_of)
    pdate = truncate_period(now, frequency).cast("timestamp_ntz")
    header = [
        pdate.alias("profile_date"), F.lit(model_name).alias("model_name"),
        F.lit(env).alias("target_environment"), F.lit("spark").alias("database_type"),
        now.alias("profiled_at"), F.lit(df.sparkSession.version).alias("engine_version"),
        F.lit(frequency).alias("profile_frequency"),
        F.concat(F.lit(env), F.lit("_"), F.lit(model_name), F.lit("_"),
                 F.date_format(pdate, "yyyyMMddHH")).alias("profile_run_id"),
        F.lit(sample_pct).cast("double").alias("sample_percentage"),
        F.lit("sampled" if sample_pct else "full").alias("data_type"),
        F.lit(len(cols)).alias("total_columns"),
    ]
    change = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("NULL")) for p in hash_parts]))
    return wide.select(*header, "*", change.alias("profile_hash"))


def merge_profile_history(history: DataFrame | None, runs: DataFrame,
                          key: str = "profile_run_id") -> DataFrame:
    """PR1m: the history of one model with the runs not yet recorded (in a new run
    columns may have come or gone; older runs keep theirs)."""
    if history is None:
        return runs
    return history.unionByName(skip_existing(runs, history, key), allowMissingColumns=True)


def read_profile_history(spark, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_profile_history(spark, path: str, runs: DataFrame) -> None:
    """PR1m sink: append the runs not yet recorded to the history at ``path`` (one
    model's), sorted by (model_name, profile_date). Nothing written is rewritten."""
    fresh = runs
    if path_exists(spark, path):
        fresh = skip_existing(runs, read_profile_history(spark, path), "profile_run_id")
    write_table(fresh, path, mode="append", cluster_by=["model_name", "profile_date"])


def distinct_rows(df: DataFrame, strict: bool = False) -> DataFrame:
    """One row ``(total_rows, distinct_rows)``.

    Default: the reference's semantics — rows are equal when the text of
    their columns, concatenated without a separator and with NULL shown as
    ``NULL``, is equal (so ('a','bc') = ('ab','c')). ``strict``: true row
    equality. Either way the shuffle key is an md5, not the row text.
    """
    cols = [_q(c) for c in df.columns]
    key = (F.md5(row_text(cols)) if not strict else
           F.md5(F.to_json(F.struct(*cols))))
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_distinct(key).alias("distinct_rows"))
