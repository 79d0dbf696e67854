"""SCD type 2 history with the timestamp strategy and hard-delete handling.

History layout: the source columns plus

* ``scd_id``          md5 of (key, updated_at) — unique per version
* ``scd_updated_at``  the source ``updated_at`` of the version
* ``valid_from``      start of validity (= updated_at)
* ``valid_to``        end of validity, NULL while the version is open

One run is one full-outer join on the key (a single shuffle) of the current
source with the version each key holds: its open one or, for a key that is
missing from the source, its last closed one. All other versions never move.

Rows without a key cannot be tracked and are left out (the not_null check on
the source reports them). A key that occurs several times in one snapshot is
an error unless ``duplicates="newest"`` asks for its newest row. A change feed,
which holds several versions of a key on purpose, goes through ``scd2_feed``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lodgeflow.functions.columns import as_timestamp, surrogate_key
from lodgeflow.operators.commit import folders, recover, replace_partitions

SCD_COLUMNS = ("scd_id", "scd_updated_at", "valid_from", "valid_to")


REPEATED = "the snapshot repeats values of"


class DuplicateSnapshotKeyError(ValueError):
    """Raised by the sink when a snapshot repeats a key."""


def scd2_init(current: DataFrame, key: str, updated_at: str = "updated_at") -> DataFrame:
    """First snapshot: every source row with a key becomes an open version."""
    ts = F.col(updated_at).cast("timestamp_ntz")
    return current.filter(F.col(key).isNotNull()).select(
        "*",
        surrogate_key(F.col(key), F.col(updated_at)).alias("scd_id"),
        ts.alias("scd_updated_at"),
        ts.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )


def one_row_per_key(current: DataFrame, key: str, updated_at: str, duplicates: str) -> DataFrame:
    """Keyed rows of a snapshot; ``raise`` makes the job that reads them fail on a repeated
    key, ``newest`` keeps the row with the latest ``updated_at`` (ties: the greatest row).

    Both need the rows by key, as the join with the history does, so they cost no
    shuffle and no job of their own."""
    keyed = current.filter(F.col(key).isNotNull())
    if duplicates == "raise":
        repeated = F.raise_error(F.lit(f"{REPEATED} {key!r}")).cast("boolean")
        counted = keyed.withColumn("__rows", F.count(F.lit(1)).over(Window.partitionBy(key)))
        return counted.filter(F.when(F.col("__rows") > 1, repeated).otherwise(F.lit(True))).drop("__rows")
    newest = F.max(F.struct(F.col(updated_at).alias("__at"), F.struct("*").alias("__row"))).alias("__newest")
    return keyed.groupBy(F.col(key).alias("__key")).agg(newest).select("__newest.__row.*")


def _ranked(history: DataFrame, key: str) -> DataFrame:
    """``__rank`` 1: the open or else last version of each key."""
    order = Window.partitionBy(key).orderBy(F.col("valid_to").desc_nulls_first(), F.col("valid_from").desc_nulls_last())
    return history.withColumn("__rank", F.row_number().over(order))


def scd2_apply(history: DataFrame | None, current: DataFrame, key: str,
               updated_at: str = "updated_at", as_of=None,
               invalidate_hard_deletes: bool = True, duplicates: str = "raise") -> DataFrame:
    """Return the new history after snapshotting ``current``.

    Rules: new key → open version; newer ``updated_at`` (strictly) → close
    the open version at the new ``updated_at`` and open a new one; equal,
    older or NULL ``updated_at`` → unchanged even if other columns differ;
    key missing from ``current`` → close at ``as_of``, or at its own start if
    that is later (when ``invalidate_hard_deletes``); a key that comes back
    after a delete opens a new version that starts at its ``updated_at``, or
    where its last one ended if that is later, with an id of its own. Closed
    versions are passed through untouched. Columns that the source gained
    are NULL in older versions, columns it lost are NULL in newer ones.
    The history is read once: versions that do not move pass through the join.
    """
    current = one_row_per_key(current, key, updated_at, duplicates)
    if history is None:
        return scd2_init(current, key, updated_at)
    return _move(_ranked(history, key), current, key, updated_at, as_of, invalidate_hard_deletes).drop("__missing")


def _move(held: DataFrame, current: DataFrame, key: str, updated_at: str, as_of,
          invalidate_hard_deletes: bool) -> DataFrame:
    """One snapshot over one version per key (others, of a ``__rank`` above 1, stay);
    ``__missing`` marks the versions of keys that the source does not hold."""
    rank = F.col("__rank") if "__rank" in held.columns else F.lit(1)
    held = held.select("*", (rank == 1).alias("has_h")).drop("__rank")
    old_cols = [c for c in held.columns if c not in (*SCD_COLUMNS, "has_h")]
    known = {c.lower() for c in old_cols}
    src_cols = old_cols + [c for c in current.columns if c.lower() not in known]
    present = {c.lower(): c for c in current.columns}

    h = held.select(*[F.col(c).alias(f"h__{c}") for c in held.columns if c != "has_h"], "has_h")
    s = current.select(*[F.col(c).alias(f"s__{c.lower()}") for c in current.columns], F.lit(True).alias("has_s"))
    j = h.join(s, (F.col(f"h__{key}") == F.col(f"s__{key.lower()}")) & F.col("has_h"), "full_outer")

    old, has_h, has_s = F.col("has_h").isNotNull(), F.coalesce("has_h", F.lit(False)), F.col("has_s").isNotNull()
    open_ = has_h & F.col("h__valid_to").isNull()
    s_at = F.col(f"s__{updated_at.lower()}")
    s_ts = s_at.cast("timestamp_ntz")
    newer = open_ & has_s & F.coalesce(s_ts > F.col("h__valid_from"), F.lit(False))
    deleted = open_ & ~has_s & F.lit(invalidate_hard_deletes)
    back = has_h & ~open_ & has_s
    close_at = (F.when(newer, s_ts)
                .when(deleted, F.greatest(as_timestamp(as_of), F.col("h__valid_from")))
                .otherwise(F.col("h__valid_to")))

    def source(c: str) -> Column:
        kind = (current.schema[present[c.lower()]] if c.lower() in present else held.schema[c]).dataType
        return F.col(f"s__{c.lower()}") if c.lower() in present else F.lit(None).cast(kind)

    def before(c: str) -> Column:
        return F.col(f"h__{c}") if c in old_cols else F.lit(None).cast(current.schema[present[c.lower()]].dataType)

    old_version = F.struct(
        *[before(c).alias(c) for c in src_cols],
        F.col("h__scd_id").alias("scd_id"),
        F.col("h__scd_updated_at").alias("scd_updated_at"),
        F.col("h__valid_from").alias("valid_from"),
        close_at.alias("valid_to"),
        (has_h & ~has_s).alias("__missing"),
    )
    s_key = F.col(f"s__{key.lower()}")
    new_version = F.struct(
        *[source(c).alias(c) for c in src_cols],
        F.when(back, surrogate_key(s_key, s_at, F.col("h__scd_id"))).otherwise(surrogate_key(s_key, s_at))
         .alias("scd_id"),
        s_ts.alias("scd_updated_at"),
        F.when(back, F.greatest(s_ts, F.col("h__valid_to"))).otherwise(s_ts).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(False).alias("__missing"),
    )
    versions = (
        F.when(newer | back, F.array(old_version, new_version))
         .when(old, F.array(old_version))
         .otherwise(F.array(new_version))
    )
    return j.select(F.explode(versions).alias("v")).select("v.*")


def scd2_feed(history: DataFrame | None, feed: DataFrame, key: str, updated_at: str = "updated_at") -> DataFrame:
    """Return the new history after a change feed that may hold several versions of a key.

    Every version later than the key's held one becomes a version of its own: it starts at
    its ``updated_at`` and ends where the next one starts; the held version ends where the
    first one starts. Of rows with equal key and ``updated_at`` the greatest counts; older,
    equal or NULL times change nothing (a key that is only known without a time opens one
    version without a start). A key that was closed opens again with its state at the
    time it was closed, or at its first later version. A feed names changes only, so a key
    that it lacks stays as it is. Feeding the same rows again changes nothing.

    A key's versions of one feed are sorted in one task (which spills): as many as
    the key had changes since the last run.
    """
    at = F.col(updated_at).cast("timestamp_ntz")
    keyed = feed.filter(F.col(key).isNotNull()).withColumn("__start", at)
    row = F.max(F.struct(*[F.col(c) for c in feed.columns])).alias("__row")
    keyed = keyed.groupBy(F.col(key).alias("__key"), "__start").agg(row)
    if history is None:
        held = None
        joined = keyed.withColumns({"__from": F.lit(None).cast("timestamp_ntz"), "__to": F.lit(None).cast("timestamp_ntz"),
                                    "__id": F.lit(None).cast("string"), "__held": F.lit(False)})
    else:
        held = _ranked(history, key)
        last = held.filter("__rank = 1").select(
            F.col(key).alias("__key"), F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to"),
            F.col("scd_id").alias("__id"), F.lit(True).alias("__held"))
        joined = keyed.join(last, "__key", "left").withColumn("__held", F.coalesce("__held", F.lit(False)))
    # an unknown start is earlier than any time, and a held version without a start gives way to any
    later = (F.col("__start").isNotNull()
             & (F.col("__from").isNull() | (F.col("__start") > F.col("__from"))))
    fresh = joined.filter(~F.col("__held") | later)
    start = F.greatest("__start", "__to")  # a closed key opens where it ended at the earliest
    by_key = Window.partitionBy("__key")
    in_order = by_key.orderBy(F.col("__opens").asc_nulls_first(), F.col("__start").asc_nulls_first())
    chain = (fresh.withColumn("__opens", start).withColumn("__next", F.lead("__opens").over(in_order))
             # what a later version replaces at once was never valid; a time beats none
             .filter(F.col("__next").isNull() | (F.col("__opens") < F.col("__next"))))
    opened = chain.select(
        "__row.*", F.when(F.col("__to").isNotNull(), surrogate_key(F.col("__key"), F.col("__start"), F.col("__id")))
        .otherwise(surrogate_key(F.col("__key"), F.col(f"__row.{updated_at}"))).alias("scd_id"),
        F.col("__start").alias("scd_updated_at"), F.col("__opens").alias("valid_from"), F.col("__next").alias("valid_to"))
    if held is None:
        return opened
    first = chain.groupBy("__key").agg(F.min("__opens").alias("__first"))
    old = held.join(first, (F.col(key) == F.col("__key")) & (F.col("__rank") == 1), "left").withColumn(
        "valid_to", F.coalesce("valid_to", "__first")).drop("__rank", "__key", "__first")
    return old.unionByName(opened, allowMissingColumns=True)


def current_rows(history: DataFrame) -> DataFrame:
    """S3: the open version of every key (``valid_to IS NULL``); on a history
    table written by ``scd2_snapshot`` this prunes to the open partition."""
    if "closed_run" in history.columns:
        return history.filter(F.col("closed_run") == OPEN_PARTITION)
    return history.filter(F.col("valid_to").isNull())


def as_of_view(history: DataFrame, ts) -> DataFrame:
    """Versions valid at ``ts``: ``valid_from <= ts < coalesce(valid_to, ∞)``."""
    t = as_timestamp(ts)
    return history.filter((F.col("valid_from") <= t)
                          & (F.col("valid_to").isNull() | (t < F.col("valid_to"))))


def single_active_version(history: DataFrame, key: str) -> DataFrame:
    """Keys with more than one open version (failing rows)."""
    return (current_rows(history).groupBy(key)
            .agg(F.count(F.lit(1)).alias("active_versions"))
            .filter(F.col("active_versions") > 1)
            .select(F.col(key).alias("offending_id"), "active_versions"))


# --- the history table sink ------------------------------------------------------
OPEN_PARTITION = "open"
MISSING_PARTITION = "missing"


def read_history(spark, path: str) -> DataFrame:
    """The history table; files written before the source gained a column lack it. A run that
    was committed but not published (see ``operators.commit``) is published first."""
    recover(spark, path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def scd2_snapshot(spark, path: str, current: DataFrame, key: str, updated_at: str = "updated_at",
                  as_of=None, run_id: str | None = None,
                  invalidate_hard_deletes: bool = True, duplicates: str = "raise") -> int:
    """Apply one snapshot to the history table at ``path``.

    The table is partitioned by ``closed_run``: open versions live in ``open``,
    the last versions of keys that the source lost in ``missing``, all other
    versions in a partition of the run that superseded them, whose name is
    unique (``run_id`` only begins it), so no run overwrites another's. A run
    reads and rewrites the first two only (partition pruning): its cost
    grows with the entities, not with the accumulated history. The new partitions
    are staged, committed by a marker and published, those that became empty
    removed with them: a crash leaves the table as it was or as it will be, and
    the next reader or run finishes the rest. Repeating a run changes nothing.
    Returns the number of versions written.
    """
    recover(spark, path, drop_uncommitted=True)
    current = one_row_per_key(current, key, updated_at, duplicates)
    first = not folders(spark, path, "closed_run=")
    if first:
        out = scd2_init(current, key, updated_at).withColumn("closed_run", F.lit(OPEN_PARTITION))
    else:
        held = read_history(spark, path).filter(
            F.col("closed_run").isin(OPEN_PARTITION, MISSING_PARTITION)).drop("closed_run")
        moved = _move(held, current, key, updated_at, as_of, invalidate_hard_deletes)
        run = f"{run_id or 'run'}-{uuid.uuid4().hex}"
        part = (F.when(F.col("valid_to").isNull(), F.lit(OPEN_PARTITION))
                .when(F.col("__missing"), F.lit(MISSING_PARTITION)).otherwise(F.lit(run)))
        out = moved.withColumn("closed_run", part).drop("__missing")
    obs = Observation(f"scd2_{uuid.uuid4().hex[:8]}")
    lives_in = lambda p: F.count(F.when(F.col("closed_run") == p, 1))
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"), lives_in(OPEN_PARTITION).alias("open"),
                      lives_in(MISSING_PARTITION).alias("missing"))
    try:
        replace_partitions(out, path, ["closed_run"], lambda: [
            f"closed_run={p}" for p in (OPEN_PARTITION, MISSING_PARTITION) if not obs.get[p]])
    except Exception as e:  # noqa: BLE001 — named for what it is, or raised as it came
        if REPEATED in str(e):
            raise DuplicateSnapshotKeyError(f"{REPEATED} {key!r}") from e
        raise
    return int(obs.get["rows"])
