"""Crash-safe sinks, change feeds, checksum increments and interleaved clustering."""

import datetime as dt
import glob
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lodgeflow.operators import commit as K
from lodgeflow.operators import load as L
from lodgeflow.operators import scd2 as S

D = dt.datetime


def snap(spark, data):
    return spark.createDataFrame(data, "id bigint, v string, updated_at timestamp_ntz")


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


class Crash(RuntimeError):
    pass


def crash_at(monkeypatch, step):
    """The n-th file-system step of publishing fails."""
    done = []

    def counted(real):
        def run(*a, **k):
            done.append(1)
            if len(done) == step:
                raise Crash()
            return real(*a, **k)
        return run

    monkeypatch.setattr(K, "delete_path", counted(K.delete_path))
    monkeypatch.setattr(K, "_told", counted(K._told))


@pytest.mark.parametrize("step", [1, 2, 3, 4, 5, 6, 7])
def test_snapshot_that_crashes_while_publishing(spark, scratch, step):
    """The next reader sees the whole run, whichever step failed."""
    path = f"{scratch}/h"
    S.scd2_snapshot(spark, path, snap(spark, [(1, "a", D(2020, 1, 1)), (2, "b", D(2020, 1, 1))]), "id")
    with pytest.MonkeyPatch.context() as patched:
        crash_at(patched, step)
        try:
            S.scd2_snapshot(spark, path, snap(spark, [(1, "a2", D(2020, 2, 1))]), "id", as_of="2020-03-01 00:00:00")
        except Crash:
            pass
    want = [(1, "a", D(2020, 2, 1)), (1, "a2", None), (2, "b", D(2020, 3, 1))]
    assert rows(S.read_history(spark, path), "id", "v", "valid_to") == sorted(want, key=repr)
    assert not K.folders(spark, path, K.MARKER)
    S.scd2_snapshot(spark, path, snap(spark, [(1, "a2", D(2020, 2, 1))]), "id", as_of="2020-03-01 00:00:00")
    assert rows(S.read_history(spark, path), "id", "v", "valid_to") == sorted(want, key=repr)
    assert not K.folders(spark, path, K.STAGED)


def test_emptied_open_partition_is_never_stale(spark, scratch):
    """The two steps of round two, write and delete, are one commit now."""
    path = f"{scratch}/h"
    one = snap(spark, [(1, "a", D(2020, 1, 1))])
    S.scd2_snapshot(spark, path, one, "id")
    with pytest.MonkeyPatch.context() as patched:
        crash_at(patched, 2)  # after the marker, when the empty partition is to go
        with pytest.raises(Crash):
            S.scd2_snapshot(spark, path, one.limit(0), "id", as_of="2020-01-10 00:00:00")
    assert rows(S.read_history(spark, path), "id", "valid_to") == [(1, D(2020, 1, 10))]


def test_uncommitted_work_is_dropped(spark, scratch):
    path = f"{scratch}/h"
    one = snap(spark, [(1, "a", D(2020, 1, 1))])
    S.scd2_snapshot(spark, path, one, "id")
    K.stage(one.withColumn("closed_run", F.lit("open")), path, ["closed_run"])  # a writer that died before its commit
    assert rows(S.read_history(spark, path), "id", "v") == [(1, "a")]
    S.scd2_snapshot(spark, path, one, "id")
    assert rows(S.read_history(spark, path), "id", "v") == [(1, "a")] and not K.folders(spark, path, K.STAGED)


def test_delete_insert_that_crashes(spark, scratch):
    path = f"{scratch}/t"
    L.write_delete_insert(spark, path, spark.createDataFrame([(1, "x", "p"), (2, "y", "p"), (3, "z", "q")],
                                                             "id int, v string, part string"), "id", "part")
    batch = spark.createDataFrame([(1, "x2", "p"), (3, "z2", "q")], "id int, v string, part string")
    for step in (2, 3, 4):
        with pytest.MonkeyPatch.context() as patched:
            crash_at(patched, step)
            with pytest.raises(Crash):
                L.write_delete_insert(spark, path, batch, "id", "part")
        K.recover(spark, path)
        assert rows(spark.read.parquet(path), "id", "v", "part") == [(1, "x2", "p"), (2, "y", "p"), (3, "z2", "q")]


def test_partition_names_are_escaped(spark, scratch):
    path = f"{scratch}/t"
    df = spark.createDataFrame([(1, "a/b:c"), (2, "é %"), (3, None), (4, "")], "id int, part string")
    L.write_table(df, path, partition_by=["part"])
    want = {K.partition_folder(spark, "part", v) for v in ("a/b:c", "é %", None)}
    assert set(K.folders(spark, path, "part=")) == want


# --- change feeds ---------------------------------------------------------------------------
def model_feed(history, feed):
    """history: id -> list of [v, start, end, updated_at]."""
    for key in {k for k, _, _ in feed if k is not None}:
        given = {}
        for k, v, at in feed:
            if k == key:
                given[at] = max(given.get(at, v), v)
        versions = history.setdefault(key, [])
        if not versions:
            todo = sorted(given.items(), key=lambda x: (x[0] is not None, x[0] or D(1, 1, 1)))
            floor = None
        else:
            last = max(versions, key=lambda x: (x[2] is None, x[2] or D(1, 1, 1)))
            todo = sorted((at, v) for at, v in given.items() if at is not None and (last[1] is None or at > last[1]))
            floor = last[2]
        chain = []
        for at, v in todo:
            opens = at if floor is None else max(at, floor)
            if chain and (chain[-1][1] is None or chain[-1][1] == opens):
                chain.pop()  # replaced at once
            chain.append([v, opens, None, at])
        for a, b in zip(chain, chain[1:]):
            a[2] = b[1]
        if chain and versions and last[2] is None:
            last[2] = chain[0][1]
        versions += chain
    return history


def test_feed_equals_a_model_on_random_runs(spark):
    rng = random.Random(3)
    model, history = {}, None
    for run in range(4):
        feed = [(rng.randrange(12) if rng.random() > 0.05 else None, f"v{run}-{rng.randrange(99)}",
                 None if rng.random() < 0.08 else D(2020, 1, 1) + dt.timedelta(days=rng.randrange(40) + 8 * run))
                for _ in range(40)]
        feed += feed[:3]
        history = L.reliable_checkpoint(S.scd2_feed(history, snap(spark, feed), "id"))
        model = model_feed(model, feed)
        want = sorted(((k, v, a, b) for k, vs in model.items() for v, a, b, _ in vs), key=repr)
        assert rows(history, "id", "v", "valid_from", "valid_to") == want
        assert history.select("scd_id").distinct().count() == history.count()
        if run == 2:  # a snapshot without some keys closes them; the last feed opens them again
            gone = {k for k in model if k % 3 == 0}
            current = S.current_rows(history).filter("id % 3 <> 0").select("id", "v", "updated_at")
            history = L.reliable_checkpoint(S.scd2_apply(history, current, "id", as_of="2020-02-20 00:00:00"))
            for k in gone:
                for version in model[k]:
                    if version[2] is None:
                        version[2] = max(D(2020, 2, 20), version[1] or D(2020, 2, 20))
    assert S.single_active_version(history, "id").count() == 0


def test_feed_keeps_what_newest_loses_and_repeats_nothing(spark):
    feed = snap(spark, [(1, "a", D(2020, 1, 1)), (1, "c", D(2020, 1, 3)), (1, "b", D(2020, 1, 2)), (1, "b0", D(2020, 1, 2))])
    h = S.scd2_feed(None, feed, "id")
    assert rows(h, "v", "valid_from", "valid_to") == [
        ("a", D(2020, 1, 1), D(2020, 1, 2)), ("b0", D(2020, 1, 2), D(2020, 1, 3)), ("c", D(2020, 1, 3), None)]
    assert rows(S.scd2_apply(None, feed, "id", duplicates="newest"), "v") == [("c",)]
    assert rows(S.scd2_feed(h, feed, "id"), "v", "valid_to") == rows(h, "v", "valid_to")
    wider = snap(spark, [(1, "d", D(2020, 1, 9))]).withColumn("extra", F.lit("x"))
    assert rows(S.scd2_feed(h, wider, "id"), "v", "extra", "valid_to")[-1] == ("d", "x", None)


def test_repeated_keys_raise_in_the_same_job(spark):
    twice = snap(spark, [(1, "a", D(2020, 1, 1)), (1, "b", D(2020, 1, 3))])
    lazy = S.scd2_apply(None, twice, "id")  # nothing has run yet
    with pytest.raises(Exception, match=S.REPEATED):
        lazy.collect()


# --- increments by checksum ------------------------------------------------------------------------
def facts(spark, data):
    return spark.createDataFrame(data, "id bigint, at timestamp_ntz, v string").withColumn("month", F.date_format("at", "yyyy-MM"))


def test_days_that_differ(spark):
    a = facts(spark, [(1, D(2020, 1, 1, 5), "x"), (2, D(2020, 1, 1, 7), "y"), (3, D(2020, 1, 2), "z"), (4, D(2020, 1, 3), None),
                      (5, D(2020, 1, 4), "k"), (5, D(2020, 1, 4), "k"), (6, None, "n")])
    assert L.differing_days(a, a.repartition(3), "at").count() == 0
    b = facts(spark, [(2, D(2020, 1, 1, 7), "y"), (1, D(2020, 1, 1, 5), "x"), (3, D(2020, 1, 2), "Z"), (5, D(2020, 1, 4), "k"),
                      (6, None, "m"), (7, D(2020, 1, 9), "new")])
    # 2nd: changed; 3rd: missing; 4th: repeated once less; none: changed; 9th: only there
    assert rows(L.differing_days(a, b, "at"), "day") == sorted(
        [(dt.date(2020, 1, 2),), (dt.date(2020, 1, 3),), (dt.date(2020, 1, 4),), (None,), (dt.date(2020, 1, 9),)], key=repr)
    batch, days = L.select_changed_days(a, b, "at")
    assert rows(L.replace_days(b, batch, days, "at"), "id", "at", "v") == rows(a, "id", "at", "v")


def test_changed_days_sink_rewrites_only_their_partitions(spark, scratch):
    path = f"{scratch}/t"
    old = [(1, D(2020, 1, 1), "x"), (2, D(2020, 2, 1), "y"), (3, D(2020, 3, 1), "z"), (9, D(2020, 4, 1), "gone"), (8, None, "n")]
    L.write_changed_days(spark, path, facts(spark, old), "at", "month")
    untouched = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/month=2020-02/*.parquet")}
    new = [(1, D(2020, 1, 1), "x"), (1, D(2020, 1, 1, 9), "late"), (2, D(2020, 2, 1), "y"), (3, D(2020, 3, 1), "Z"),
           (4, D(2020, 5, 1), "new"), (8, None, "N")]
    assert L.write_changed_days(spark, path, facts(spark, new), "at", "month") == 5
    assert rows(spark.read.parquet(path), "id", "at", "v") == rows(facts(spark, new), "id", "at", "v")
    assert {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/month=2020-02/*.parquet")} == untouched
    assert not glob.glob(f"{path}/month=2020-04")
    assert L.write_changed_days(spark, path, facts(spark, new), "at", "month") == 0


def test_since_last_load_opens_the_last_months_only(spark, scratch):
    """The pages of earlier months may even be unreadable."""
    from lodgeflow.plans.jobs import incremental_fct_load

    path = f"{scratch}/fct"
    reviews = [(k, D(2020, m, 3), f"r{k}", f"text {k} {m}", "positive") for k in range(4) for m in (1, 2, 3)]
    schema = "listing_id bigint, date timestamp_ntz, reviewer_name string, comments string, sentiment string"
    incremental_fct_load(spark, spark.createDataFrame(reviews, schema), path)
    kept = {}
    for f in glob.glob(f"{path}/review_month=2020-01/*.parquet"):
        with open(f, "r+b") as pages:
            kept[f] = pages.read()
            pages.seek(4)
            pages.write(bytes(60))
        os.remove(os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc"))
    with pytest.raises(Exception):
        spark.read.parquet(path).toPandas()
    more = reviews + [(9, D(2020, 3, 4), "n", "new", "neutral"), (9, D(2020, 4, 4), "n", "newer", "neutral")]
    incremental_fct_load(spark, spark.createDataFrame(more, schema), path)
    for f, data in kept.items():
        with open(f, "wb") as out:
            out.write(data)
    assert spark.read.parquet(path).count() == len(more)


# --- interleaved clustering --------------------------------------------------------------------------
def overlapping(path, column, value):
    """Share of files whose statistics allow ``value``."""
    hits, files = 0, glob.glob(f"{path}/*.parquet")
    for f in files:
        meta = pq.ParquetFile(f).metadata
        i = [meta.schema.column(k).name for k in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(i).statistics for g in range(meta.num_row_groups)]
        hits += any(s.min <= value <= s.max for s in stats)
    return hits / len(files), len(files)


def test_a_filter_on_either_column_skips_files(spark, scratch):
    df = spark.range(64_000).selectExpr("id", "CAST(pow(id * 7919 % 64000, 1.5) AS bigint) AS a", "CAST(id * 104729 % 64007 AS double) AS b")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        L.write_table(df, f"{scratch}/z", zorder_by=["a", "b"])
        L.write_table(df, f"{scratch}/s", cluster_by=["a", "b"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert spark.read.parquet(f"{scratch}/z").count() == 64_000
    for column, value in (("a", 8_000_000), ("b", 20_000.0)):
        share, n = overlapping(f"{scratch}/z", column, value)
        assert n == 16 and share <= 0.5, (column, share)
    assert overlapping(f"{scratch}/s", "b", 20_000.0)[0] == 1.0  # a plain sort skips nothing by its second column


def test_interleaved_key_of_nulls_and_dates(spark, scratch):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, None), (None, dt.date(2020, 1, 3)), (None, None)], "a int, d date")
    L.write_table(df, f"{scratch}/z", zorder_by=["a", "d"])
    assert rows(spark.read.parquet(f"{scratch}/z"), "a", "d") == rows(df, "a", "d")
    L.write_table(df.limit(0), f"{scratch}/e", zorder_by=["a", "d"])
    assert spark.read.parquet(f"{scratch}/e").count() == 0
