"""Load strategies: full rebuild, increments, keyed writes, schema drift.

The operators are pure (``target, batch -> new target``); the sinks write
them. Plain Parquet has no MERGE, and overwriting a path that is being read
fails, so keyed sinks stage the new content of the touched partitions beside
the old one, commit it by a marker and move it into place (``operators.commit``).
"""

from __future__ import annotations

import time
import uuid
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeflow.operators.commit import folders, partition_folder, recover, replace_partitions
from lodgeflow.session import path_exists, reliable_checkpoint


class SchemaDriftError(ValueError):
    """Raised by the ``fail`` drift policy."""


class DuplicateKeyError(ValueError):
    """Raised by ``merge_upsert`` when the batch repeats a key."""


# --- W8 --------------------------------------------------------------------
ZORDER_BITS = 8


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = ZORDER_BITS) -> Column:
    """A number whose order keeps rows near that are near in each of ``columns``: the bits of
    their range ranks, interleaved. Ranks come from ``2^bits − 1`` approximate quantiles per
    column (one aggregate; sketches merge), so skewed values spread evenly; NULL ranks last."""
    share = [k / 2 ** bits for k in range(1, 2 ** bits)]
    as_number = lambda c: (F.col(c) if isinstance(df.schema[c].dataType, T.NumericType)
                           else F.unix_micros(F.col(c).cast("timestamp"))).cast("double")
    found = df.agg(*[F.percentile_approx(as_number(c), share, 10 * 2 ** bits).alias(f"b{i}")
                     for i, c in enumerate(columns)]).first()

    def rank_of(c: str, bounds: list) -> Column:
        x = as_number(c)
        known = F.array(*[F.lit(float(b)) for b in sorted(set(bounds))]).cast("array<double>")
        below = F.size(F.filter(known, lambda b: b < x))
        return F.when(x.isNull(), F.lit(2 ** bits - 1)).otherwise(below).cast("bigint")

    key = F.lit(0).cast("bigint")
    for i, c in enumerate(columns):
        rank = rank_of(c, found[f"b{i}"] or [])
        for k in range(bits):
            bit = F.shiftright(rank, k).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(bit, k * len(columns) + i))
    return key


# --- W1 --------------------------------------------------------------------
def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None,
                cluster_by: Sequence[str] | None = None, fmt: str = "parquet",
                zorder_by: Sequence[str] | None = None) -> None:
    """Full rebuild sink. ``cluster_by`` (W8) range-partitions and sorts the
    rows on those columns so files hold narrow, sorted key ranges and
    Parquet min/max statistics can skip them; ``zorder_by`` does so on an interleaved
    key of several columns (numbers, dates or timestamps), so that a filter on any one
    of them skips files. With ``partition_by`` alone the
    rows are rebalanced on the partition columns first (one shuffle; AQE
    splits a hot partition value and merges small ones), so each directory
    gets a few right-sized files instead of one per writing task."""
    out = df
    if zorder_by:
        keyed = out.withColumn("__z", zorder_key(out, zorder_by))
        out = keyed.repartitionByRange("__z").sortWithinPartitions("__z").drop("__z")
    elif cluster_by:
        out = out.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    elif partition_by:
        out = out.hint("rebalance", *partition_by)
    writer = out.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


# --- W2 / F2 / F3 -----------------------------------------------------------
def select_increment(source: DataFrame, target: DataFrame | None, date_col: str,
                     start=None, end=None) -> DataFrame:
    """Rows of ``source`` to load into ``target``.

    * no target (first run or full refresh): every row;
    * both ``start`` and ``end``: the half-open window ``[start, end)``;
    * otherwise *since last*: ``date_col > max(target.date_col)``. The
      maximum is a scalar subquery pushed into the scan as a runtime filter.
      An empty target has a NULL maximum and loads nothing, and rows of the
      last loaded date that arrive late are skipped — ``select_changed_days``
      finds them, or reload a window to repair them.
    """
    if target is None:
        return source
    c = F.col(date_col)
    if start is not None and end is not None:
        return source.filter((c >= F.lit(start).cast("timestamp_ntz"))
                             & (c < F.lit(end).cast("timestamp_ntz")))
    high_water = target.select(F.max(date_col)).scalar()
    return source.filter(c > high_water)


def day_checksums(df: DataFrame, date_col: str, columns: Sequence[str]) -> DataFrame:
    """``(day, rows, sum_a, sum_b)``: what the rows of a day add up to, in any order. Two sums of
    independent 64-bit row hashes; a task hands on one row per day, whatever it read."""
    cells = [F.col(c) for c in columns]
    whole = lambda h: F.sum(h.cast("decimal(20,0)"))
    return df.groupBy(F.to_date(date_col).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), whole(F.xxhash64(*cells)).alias("sum_a"),
        whole(F.xxhash64(F.lit("second half"), *cells)).alias("sum_b"))


def differing_days(source: DataFrame, target: DataFrame, date_col: str) -> DataFrame:
    """``(day)`` of the days whose rows are not the same on both sides (late, changed, removed
    or repeated rows), a NULL day included. The columns of the target are compared."""
    columns = [c for c in target.columns if c.lower() in {x.lower() for x in source.columns}]
    side = lambda df, p: day_checksums(df, date_col, columns).select(
        *[F.col(c).alias(p + c) for c in ("day", "rows", "sum_a", "sum_b")])
    j = side(source, "s_").join(side(target, "t_"), F.col("s_day").eqNullSafe(F.col("t_day")), "full_outer")
    same = F.lit(True)
    for c in ("rows", "sum_a", "sum_b"):
        same = same & F.col(f"s_{c}").eqNullSafe(F.col(f"t_{c}"))
    return j.filter(~same).select(F.coalesce("s_day", "t_day").alias("day"))


def select_changed_days(source: DataFrame, target: DataFrame, date_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``source`` on the days that differ from ``target``, and these days (stored):
    an increment that finds late and changed rows wherever they are, without a window."""
    days = reliable_checkpoint(differing_days(source, target, date_col))
    day = days.select(F.col("day").alias("__day"))
    return source.join(day, F.to_date(date_col).eqNullSafe(F.col("__day")), "left_semi"), days


def replace_days(target: DataFrame, batch: DataFrame, days: DataFrame, date_col: str) -> DataFrame:
    """``target`` with all rows of ``days`` replaced by ``batch``."""
    day = days.select(F.col("day").alias("__day"))
    kept = target.join(day, F.to_date(date_col).eqNullSafe(F.col("__day")), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def write_changed_days(spark: SparkSession, path: str, source: DataFrame, date_col: str, partition_col: str) -> int:
    """Sink: make the table at ``path`` equal ``source`` on every day that differs; returns the
    number of such days. Partitions without such a day are not rewritten; a partition that
    becomes empty is removed. ``partition_col`` must follow from the date."""
    recover(spark, path, drop_uncommitted=True)
    if not folders(spark, path, f"{partition_col}="):
        write_table(source, path, partition_by=[partition_col])
        return source.select(F.to_date(date_col)).distinct().count()
    target = spark.read.parquet(path)
    batch, days = select_changed_days(source, target, date_col)
    day = days.select(F.col("day").alias("__day"))
    same_day = F.to_date(date_col).eqNullSafe(F.col("__day"))
    # one row per partition of the table
    touched = {r[0] for df in (target, batch) for r in df.join(day, same_day, "left_semi")
               .select(partition_col).distinct().collect()}
    if touched:
        known = [t for t in touched if t is not None]
        inside = F.col(partition_col).isin(known) if known else F.lit(False)
        inside = inside | F.col(partition_col).isNull() if None in touched else inside
        new = replace_days(target.filter(inside), batch, days, date_col)
        left = {r[0] for r in new.select(partition_col).distinct().collect()}
        gone = [partition_folder(spark, partition_col, t) for t in touched - left]
        replace_partitions(new.hint("rebalance", partition_col), path, [partition_col], lambda: gone)
    return days.count()


# --- W3 ---------------------------------------------------------------------
def delete_insert(target: DataFrame, batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Delete target rows whose key occurs in the batch, then insert the batch.

    Duplicates inside the batch stay; target rows absent from the batch stay.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch)


# --- W4 ---------------------------------------------------------------------
def merge_upsert(target: DataFrame, batch: DataFrame, key: str,
                 exclude_update: Iterable[str] = (),
                 check_duplicates: bool = True) -> DataFrame:
    """Keyed merge: matched rows take the batch values except the excluded
    columns (which keep the target value), unmatched rows of either side are
    kept. Both inputs must have the same columns (see ``reconcile_schema``).
    """
    if check_duplicates:
        dup = batch.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > 1).limit(1)
        if dup.count() > 0:
            raise DuplicateKeyError(f"batch repeats values of merge key {key!r}")
    excluded = {c.lower() for c in exclude_update}
    # markers, not the key, tell which side a row has: a NULL key matches nothing
    t = target.withColumn("__in_target", F.lit(True)).alias("t")
    b = batch.withColumn("__in_batch", F.lit(True)).alias("b")
    j = t.join(b, F.col(f"t.{key}") == F.col(f"b.{key}"), "full_outer")
    in_batch = F.col("b.__in_batch").isNotNull()
    matched = F.col("t.__in_target").isNotNull() & in_batch
    cols = []
    for c in target.columns:
        if c.lower() in excluded:
            v = F.when(matched | ~in_batch, F.col(f"t.{c}")).otherwise(F.col(f"b.{c}"))
        else:
            v = F.when(in_batch, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}"))
        cols.append(v.alias(c))
    return j.select(*cols)


# --- W6 ---------------------------------------------------------------------
def schema_diff_fields(old: T.StructType, new: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(change, column, old_type, new_type) for added, removed and retyped columns."""
    o = {f.name.lower(): f for f in old.fields}
    n = {f.name.lower(): f for f in new.fields}
    out = []
    for name, f in n.items():
        if name not in o:
            out.append(("column_added", f.name, None, f.dataType.simpleString()))
        elif o[name].dataType != f.dataType:
            out.append(("type_changed", f.name, o[name].dataType.simpleString(),
                        f.dataType.simpleString()))
    for name, f in o.items():
        if name not in n:
            out.append(("column_removed", f.name, f.dataType.simpleString(), None))
    return out


def reconcile_schema(target: DataFrame, batch: DataFrame,
                     policy: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Apply an on-schema-change policy before appending ``batch``.

    * ``fail``: raise when the columns or their types differ;
    * ``ignore``: keep the target's columns (new batch columns are dropped);
    * ``append_new_columns``: add the batch's new columns to the target;
    * ``sync_all_columns``: add new columns and drop columns the batch lost.
    Only the schemas are compared; no data is read.
    """
    diff = schema_diff_fields(target.schema, batch.schema)
    if not diff:
        return target, batch
    if policy == "fail":
        raise SchemaDriftError(f"schema of the batch differs from the target: {diff}")
    tcols = {c.lower(): c for c in target.columns}
    bcols = {c.lower(): c for c in batch.columns}
    if policy == "ignore":
        cols = [F.col(bcols[c]).alias(tcols[c]) if c in bcols
                else F.lit(None).cast(target.schema[tcols[c]].dataType).alias(tcols[c])
                for c in tcols]
        return target, batch.select(*cols)
    if policy == "append_new_columns":
        names = list(tcols) + [c for c in bcols if c not in tcols]
    elif policy == "sync_all_columns":
        names = list(bcols)
    else:
        raise ValueError(f"unknown policy {policy!r}")

    def conform(df: DataFrame, present: dict[str, str]) -> DataFrame:
        out = []
        for c in names:
            field = batch.schema[bcols[c]] if c in bcols else target.schema[tcols[c]]
            if c in present:
                out.append(F.col(present[c]).cast(field.dataType).alias(field.name))
            else:
                out.append(F.lit(None).cast(field.dataType).alias(field.name))
        return df.select(*out)

    return conform(target, tcols), conform(batch, bcols)


# --- W7 / F6 ----------------------------------------------------------------
def skip_existing(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Drop batch rows whose key is already recorded (``NOT IN`` as anti join).

    SQL ``NOT IN`` returns nothing once the target holds a NULL key; the
    anti join keeps the rows instead. Keys here are never NULL.
    """
    return batch.join(target.select(key), key, "left_anti")


# --- keyed sinks --------------------------------------------------------------
def write_delete_insert(spark: SparkSession, path: str, batch: DataFrame,
                        key: str, partition_col: str, partitions: Column | None = None,
                        seen: Observation | None = None) -> None:
    """Sink for W3 on a table partitioned by ``partition_col``.

    The key must determine the partition (true for review ids, which hash the
    review date), so only the partitions the batch touches are read, merged,
    staged, committed and published (``operators.commit``: a crash leaves the table as
    it was or as it will be). ``partitions`` is a literal condition on ``partition_col``
    that holds for every batch row (a load knows its bounds): it prunes the target's
    folders at any batch size, where the semi join prunes only a batch small enough to
    broadcast. ``seen`` observes the ``rows`` written.
    """
    watched = lambda df: df if seen is None else df.observe(seen, F.count(F.lit(1)).alias("rows"))
    recover(spark, path, drop_uncommitted=True)
    if not folders(spark, path, f"{partition_col}="):  # first load
        write_table(watched(batch), path, partition_by=[partition_col])
        return
    target = spark.read.parquet(path)
    if partitions is not None:
        target = target.filter(partitions)
    affected = target.join(batch.select(partition_col), partition_col, "left_semi")
    merged = delete_insert(affected, batch.select(*target.columns), key).hint("rebalance", partition_col)
    replace_partitions(watched(merged), path, [partition_col])


# --- W9 helpers live in checks; W10 ------------------------------------------
AUDIT_SCHEMA = T.StructType([
    T.StructField("invocation_id", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_affected", T.LongType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("finished_at", T.TimestampNTZType()),
    T.StructField("execution_seconds", T.DoubleType()),
    T.StructField("error", T.StringType()),
])


def audited(spark: SparkSession, step: str, audit_path: str, run, invocation_id: str | None = None) -> dict:
    """Run ``run()`` (which may return the rows it affected) and append one
    audit row — invocation id, step, status, rows, start/end, seconds, error.
    A failing step is recorded, then re-raised."""
    import datetime as dt

    invocation_id = invocation_id or uuid.uuid4().hex
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    t0 = time.perf_counter()
    status, error, rows = "success", None, None
    try:
        rows = run()
    except Exception as exc:  # noqa: BLE001 — recorded, then re-raised
        status, error = "error", f"{type(exc).__name__}: {exc}"
        raise
    finally:
        finished = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        record = {"invocation_id": invocation_id, "step": step, "status": status,
                  "rows_affected": rows, "started_at": started, "finished_at": finished,
                  "execution_seconds": round(time.perf_counter() - t0, 3), "error": error}
        spark.createDataFrame([record], AUDIT_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(audit_path)
    return record


def audited_write(df: DataFrame, path: str, step: str, audit_path: str,
                  invocation_id: str | None = None, **write_kwargs) -> dict:
    """Write ``df`` and append one audit row for the step.

    Rows are counted with ``df.observe`` during the write itself, so the
    audit costs no second pass over the data.
    """
    obs = Observation(f"audit_{step}_{uuid.uuid4().hex[:8]}")

    def run() -> int:
        write_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), path, **write_kwargs)
        return int(obs.get["rows"])

    return audited(df.sparkSession, step, audit_path, run, invocation_id)
