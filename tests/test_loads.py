"""Incremental selection, keyed writes, schema drift and SCD-2 sequences."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodgeflow.operators import load as L
from lodgeflow.operators import scd2 as S

D = dt.datetime


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_since_last_semantics(spark):
    src = spark.createDataFrame([(1, D(2020, 1, 1)), (2, D(2020, 1, 2)), (3, D(2020, 1, 2)),
                                 (4, D(2020, 1, 3)), (5, None)], "id bigint, d timestamp_ntz")
    target = spark.createDataFrame([(2, D(2020, 1, 2))], "id bigint, d timestamp_ntz")
    # strict '>': the late row 3 of the last loaded date is skipped; NULL never loads
    assert rows(L.select_increment(src, target, "d"), "id") == [(4,)]
    empty = target.limit(0)
    assert L.select_increment(src, empty, "d").count() == 0          # NULL max → nothing
    assert L.select_increment(src, None, "d").count() == 5           # first run: everything


def test_window_needs_both_bounds(spark):
    src = spark.createDataFrame([(1, D(2020, 1, 1)), (2, D(2020, 1, 2)), (3, D(2020, 1, 3))],
                                "id bigint, d timestamp_ntz")
    target = src.filter("id = 1")
    win = L.select_increment(src, target, "d", "2020-01-02 00:00:00", "2020-01-03 00:00:00")
    assert rows(win, "id") == [(2,)]                                  # end is exclusive
    only_start = L.select_increment(src, target, "d", "2020-01-02 00:00:00", None)
    assert rows(only_start, "id") == [(2,), (3,)]                     # falls back to since-last


def test_delete_insert_keeps_batch_duplicates(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k bigint, v string")
    batch = spark.createDataFrame([(2, "B"), (2, "B2"), (4, "D")], "k bigint, v string")
    assert rows(L.delete_insert(target, batch, "k"), "k", "v") == \
        [(1, "a"), (2, "B"), (2, "B2"), (3, "c"), (4, "D")]


def test_merge_upsert_excludes_columns(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k bigint, v string, t bigint")
    batch = spark.createDataFrame([(2, "B", 99), (3, "C", 30)], "k bigint, v string, t bigint")
    got = rows(L.merge_upsert(target, batch, "k", exclude_update=["T"]), "k", "v", "t")
    assert got == [(1, "a", 10), (2, "B", 20), (3, "C", 30)]


def test_merge_upsert_rejects_duplicate_batch_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k bigint, v string")
    batch = spark.createDataFrame([(2, "x"), (2, "y")], "k bigint, v string")
    with pytest.raises(L.DuplicateKeyError):
        L.merge_upsert(target, batch, "k")


def test_skip_existing_with_null_key_in_target(spark):
    batch = spark.createDataFrame([(1,), (2,)], "k bigint")
    target = spark.createDataFrame([(1,), (None,)], "k bigint")
    assert rows(L.skip_existing(batch, target, "k"), "k") == [(2,)]


def test_schema_drift_policies(spark):
    target = spark.createDataFrame([(1, "a", 1.0)], "k bigint, v string, old double")
    batch = spark.createDataFrame([(2, "b", True)], "k bigint, v string, new boolean")
    with pytest.raises(L.SchemaDriftError):
        L.reconcile_schema(target, batch, "fail")
    t, b = L.reconcile_schema(target, batch, "sync_all_columns")
    assert t.columns == b.columns == ["k", "v", "new"]
    assert t.collect()[0].new is None
    t, b = L.reconcile_schema(target, batch, "append_new_columns")
    assert t.columns == b.columns == ["k", "v", "old", "new"]
    t, b = L.reconcile_schema(target, batch, "ignore")
    assert b.columns == ["k", "v", "old"]
    same_t, same_b = L.reconcile_schema(target, target, "fail")
    assert same_t is target


def test_partition_local_delete_insert_sink(spark, scratch):
    path = f"{scratch}/fct"
    first = spark.createDataFrame([("a", "2020-01", 1), ("b", "2020-01", 2), ("c", "2020-02", 3)],
                                  "id string, part string, v bigint")
    L.write_delete_insert(spark, path, first, "id", "part")
    batch = spark.createDataFrame([("b", "2020-01", 20), ("d", "2020-03", 4)],
                                  "id string, part string, v bigint")
    L.write_delete_insert(spark, path, batch, "id", "part")
    L.write_delete_insert(spark, path, batch, "id", "part")            # idempotent replay
    got = rows(spark.read.parquet(path), "id", "part", "v")
    assert got == [("a", "2020-01", 1), ("b", "2020-01", 20), ("c", "2020-02", 3), ("d", "2020-03", 4)]


def test_audited_write_records_rows(spark, scratch):
    df = spark.range(7)
    rec = L.audited_write(df, f"{scratch}/t", "step1", f"{scratch}/audit", "inv-1")
    assert rec["rows_affected"] == 7 and rec["status"] == "success"
    audit = spark.read.parquet(f"{scratch}/audit").collect()
    assert [(a.invocation_id, a.step, a.rows_affected) for a in audit] == [("inv-1", "step1", 7)]


def test_merge_keeps_null_key_rows(spark):
    target = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    batch = spark.createDataFrame([("a", 10), (None, 20), (None, 30)], "k string, v int")
    got = sorted((tuple(r) for r in L.merge_upsert(target, batch, "k").collect()), key=repr)
    assert got == sorted([("a", 10), (None, 2), (None, 20), (None, 30)], key=repr)


# --- SCD-2 --------------------------------------------------------------------------
def snap(spark, data):
    return spark.createDataFrame(data, "id bigint, v string, updated_at timestamp_ntz")


def test_scd2_sequence(spark):
    v1 = snap(spark, [(1, "a", D(2020, 1, 1)), (2, "b", D(2020, 1, 1)), (3, "c", D(2020, 1, 1)),
                      (4, "d", D(2020, 1, 1)), (5, "e", D(2020, 1, 1))])
    h1 = S.scd2_apply(None, v1, "id")
    v2 = snap(spark, [
        (1, "a2", D(2020, 2, 1)),    # changed (newer)
        (2, "b2", D(2020, 1, 1)),    # equal updated_at, other change → ignored
        (3, "c2", D(2019, 1, 1)),    # older → ignored
        (4, "d2", None),             # NULL updated_at → ignored
        # 5 deleted
        (6, "f", D(2020, 2, 1)),     # new
    ])
    h2 = S.scd2_apply(h1, v2, "id", as_of="2020-03-01 00:00:00")
    got = rows(h2, "id", "v", "valid_from", "valid_to")
    assert got == [
        (1, "a", D(2020, 1, 1), D(2020, 2, 1)), (1, "a2", D(2020, 2, 1), None),
        (2, "b", D(2020, 1, 1), None), (3, "c", D(2020, 1, 1), None),
        (4, "d", D(2020, 1, 1), None), (5, "e", D(2020, 1, 1), D(2020, 3, 1)),
        (6, "f", D(2020, 2, 1), None)]
    # same run twice: nothing changes except the already-closed delete
    h2b = S.scd2_apply(h2, v2, "id", as_of="2020-03-02 00:00:00")
    assert rows(h2b, "id", "v", "valid_from", "valid_to") == got
    # third run: the deleted key comes back → new open version
    v3 = v2.unionByName(snap(spark, [(5, "e3", D(2020, 4, 1))]))
    h3 = S.scd2_apply(h2, v3, "id", as_of="2020-05-01 00:00:00")
    assert rows(S.current_rows(h3).filter("id = 5"), "v") == [("e3",)]
    assert S.single_active_version(h3, "id").count() == 0
    assert h3.select("scd_id").distinct().count() == h3.count()
    # as-of view: half-open validity
    at = rows(S.as_of_view(h3, "2020-02-01 00:00:00"), "id", "v")
    assert (1, "a2") in at and (1, "a") not in at


def test_single_active_version_flags_duplicates(spark):
    hist = S.scd2_init(snap(spark, [(1, "a", D(2020, 1, 1)), (1, "b", D(2020, 1, 2))]), "id")
    assert rows(S.single_active_version(hist, "id"), "offending_id", "active_versions") == [(1, 2)]


def test_scd2_registered_scenario_invariants(spark):
    from lodgeflow.plans import registry as R
    h = R.scd_listings_history(spark, "/root/testdata/sf0.001")
    assert S.single_active_version(h, "id").count() == 0
    assert h.select("scd_id").distinct().count() == h.count()
    overlap = (h.alias("a").join(h.alias("b"), "id")
               .filter((F.col("a.scd_id") < F.col("b.scd_id"))
                       & (F.col("a.valid_from") < F.coalesce(F.col("b.valid_to"), F.lit(D(9999, 1, 1))))
                       & (F.col("b.valid_from") < F.coalesce(F.col("a.valid_to"), F.lit(D(9999, 1, 1))))))
    assert overlap.count() == 0


def test_scd2_snapshot_table_matches_in_memory_history(spark, scratch):
    path = f"{scratch}/hist"
    v1 = snap(spark, [(1, "a", D(2020, 1, 1)), (2, "b", D(2020, 1, 1)), (3, "c", D(2020, 1, 1))])
    v2 = snap(spark, [(1, "a2", D(2020, 2, 1)), (2, "b~", D(2020, 1, 1)), (4, "d", D(2020, 2, 1))])
    v3 = snap(spark, [(1, "a3", D(2020, 3, 1)), (3, "c3", D(2020, 3, 1)), (4, "d", D(2020, 2, 1))])
    runs = [(v1, "2020-01-15 00:00:00", "r1"), (v2, "2020-02-15 00:00:00", "r2"),
            (v3, "2020-03-15 00:00:00", "r3")]
    hist = None
    for df, as_of, run in runs:
        S.scd2_snapshot(spark, path, df, "id", as_of=as_of, run_id=run)
        hist = S.scd2_apply(hist, df, "id", as_of=as_of)
    S.scd2_snapshot(spark, path, v3, "id", as_of="2020-03-15 00:00:00", run_id="r3")  # rerun
    table = spark.read.parquet(path)
    cols = ("id", "v", "valid_from", "valid_to", "scd_id")
    assert rows(table, *cols) == rows(hist, *cols)
    assert rows(S.current_rows(table), "id", "v") == [(1, "a3"), (3, "c3"), (4, "d")]
    parts = {r.closed_run for r in table.select("closed_run").distinct().collect()}
    assert {p.split("-")[0] for p in parts} == {"open", "missing", "r2", "r3"}
    assert len(parts) == 4  # the repeated run closed nothing
    plan = S.current_rows(table)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(closed_run" in plan and "(closed_run" in plan and "= open)" in plan


def history(spark, path):
    return rows(S.read_history(spark, path), "id", "v", "valid_from", "valid_to")


def invariants(table):
    assert table.select("scd_id").distinct().count() == table.count()
    assert S.single_active_version(table, "id").count() == 0
    far = F.lit(D(9999, 1, 1))
    overlap = table.alias("a").join(table.alias("b"), "id").filter(
        (F.col("a.scd_id") < F.col("b.scd_id")) & (F.col("a.valid_from") < F.coalesce(F.col("b.valid_to"), far))
        & (F.col("b.valid_from") < F.coalesce(F.col("a.valid_to"), far)))
    assert overlap.count() == 0


def test_snapshots_without_run_id_keep_each_others_history(spark, scratch):
    path = f"{scratch}/h"
    S.scd2_snapshot(spark, path, snap(spark, [(1, "a", D(2020, 1, 1)), (2, "b", D(2020, 1, 1))]), "id")
    S.scd2_snapshot(spark, path, snap(spark, [(1, "a2", D(2020, 1, 2)), (2, "b", D(2020, 1, 1))]), "id")
    S.scd2_snapshot(spark, path, snap(spark, [(1, "a2", D(2020, 1, 2)), (2, "b2", D(2020, 1, 2))]), "id")
    assert history(spark, path) == [
        (1, "a", D(2020, 1, 1), D(2020, 1, 2)), (1, "a2", D(2020, 1, 2), None),
        (2, "b", D(2020, 1, 1), D(2020, 1, 2)), (2, "b2", D(2020, 1, 2), None)]
    invariants(S.read_history(spark, path))


def test_emptied_source_reappearing_null_and_new_columns(spark, scratch):
    path, one = f"{scratch}/h", snap(spark, [(1, "a", D(2020, 1, 1)), (None, "n", D(2020, 1, 1))])
    S.scd2_snapshot(spark, path, one, "id", as_of="2020-01-05 00:00:00")
    S.scd2_snapshot(spark, path, one.limit(0), "id", as_of="2020-01-10 00:00:00")
    assert history(spark, path) == [(1, "a", D(2020, 1, 1), D(2020, 1, 10))]
    S.scd2_snapshot(spark, path, one, "id", as_of="2020-01-15 00:00:00")       # back, with its old updated_at
    S.scd2_snapshot(spark, path, one.limit(0), "id", as_of="2020-01-20 00:00:00")
    wider = one.withColumn("extra", F.lit("x"))
    S.scd2_snapshot(spark, path, wider, "id", as_of="2020-01-25 00:00:00")
    S.scd2_snapshot(spark, path, wider, "id", as_of="2020-01-26 00:00:00")       # unchanged
    table = S.read_history(spark, path)
    assert rows(table, "v", "valid_from", "valid_to", "extra") == [
        ("a", D(2020, 1, 1), D(2020, 1, 10), None), ("a", D(2020, 1, 10), D(2020, 1, 20), None),
        ("a", D(2020, 1, 20), None, "x")]
    invariants(table)


def test_repeated_snapshot_keys(spark, scratch):
    twice = snap(spark, [(1, "a", D(2020, 1, 1)), (1, "b", D(2020, 1, 3)), (1, "c", None)])
    with pytest.raises(S.DuplicateSnapshotKeyError):
        S.scd2_snapshot(spark, f"{scratch}/h", twice, "id")
    S.scd2_snapshot(spark, f"{scratch}/h", twice, "id", duplicates="newest")
    assert history(spark, f"{scratch}/h") == [(1, "b", D(2020, 1, 3), None)]
