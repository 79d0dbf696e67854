"""End-to-end: full build with audit and checks, incremental loads, streaming."""

import datetime as dt
import os

from pyspark.sql import functions as F

from lodgeflow.operators.load import write_table
from lodgeflow.plans import models as M
from lodgeflow.plans.jobs import (REVIEW_PARTITION, incremental_fct_load, run_full_build,
                                      with_review_partition)
from lodgeflow.sources.fixtures import load_raw
from lodgeflow.sources.raw import read_calendar, read_source
from lodgeflow.streaming.incremental import start_review_load

SF = "/root/testdata/sf0.001"


def test_full_build_audits_and_checks(spark, scratch):
    results = {r.check_name: (r.failures, r.status) for r in
               run_full_build(spark, SF, scratch, "inv-test").collect()}
    # the mapped data has listings whose host is missing: the relationship checks fail
    assert results["relationships_dim_listings_host_id"][1] == "fail"
    assert results["source_listings_host_exists"][1] == "fail"
    assert results["unique_fct_reviews_review_id"] == (0, "pass")
    assert results["missing_months"] == (0, "pass")
    assert os.path.isdir(f"{scratch}/_failures/relationships_dim_listings_host_id")
    assert results["unique_scd_raw_listings_scd_id"] == (0, "pass")
    assert results["of_type_price_sentiment_correlation_price_stddev"] == (0, "pass")
    assert sum(k.startswith("not_null_") for k in results) == 30 and len(results) >= 95
    audit = {r.step: r.rows_affected for r in spark.read.parquet(f"{scratch}/_audit").collect()}
    raw = load_raw(spark, SF)
    assert audit["scd_raw_listings"] == raw["listings"].count()
    assert audit["fct_reviews"] == raw["reviews"].filter("comments IS NOT NULL").count()
    assert audit["price_sentiment_correlation"] == 3
    assert spark.read.parquet(f"{scratch}/price_sentiment_correlation").count() == 3


def test_build_from_raw_files_with_csv_calendar(spark, scratch):
    """End to end from declared sources; the second run changes nothing but appends its results."""
    import pytest

    from lodgeflow.operators.checks import CheckError
    from lodgeflow.plans.jobs import read_declared
    raw = load_raw(spark, SF)
    for name in ("hosts", "listings", "reviews"):
        df = raw[name]
        if name == "listings":  # keep the sound ones, so that only checks on prices can fail
            df = df.filter("host_id > 0 AND minimum_nights > 0")
        df.write.parquet(f"{scratch}/in/{name}")
    with open(f"{scratch}/in/moons.csv", "w") as f:
        f.write("full_moon_date\n" + "".join(f"{r[0]}\n" for r in raw["calendar"].collect()))
    src = read_declared(spark, *[f"{scratch}/in/{n}" for n in ("hosts", "listings", "reviews")], f"{scratch}/in/moons.csv")
    out = f"{scratch}/out"
    first = run_full_build(spark, src, out, as_of="2002-01-01 00:00:00").collect()
    with pytest.raises(CheckError):  # reviews of the listings left out have no parent
        run_full_build(spark, src, out, as_of="2002-01-02 00:00:00", stop_on_error=True)
    results = spark.read.parquet(f"{out}/_check_results")
    assert results.select("invocation_id").distinct().count() == 2
    assert results.count() == 2 * len(first) + 9           # the second run also compares schemas
    assert results.filter("check_name LIKE 'schema_changes_%' AND status <> 'pass'").count() == 0
    from lodgeflow.operators.scd2 import read_history
    assert read_history(spark, f"{out}/scd_raw_hosts").count() == src["hosts"].count()
    want = M.build_models({**raw, "listings": src["listings"]})["price_sentiment_correlation"]
    got = spark.read.parquet(f"{out}/price_sentiment_correlation")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_old_failures_go_when_a_check_passes(spark, scratch):
    from lodgeflow.operators import checks as C
    bad, good = (spark.createDataFrame([(v,)], "v int") for v in (None, 1))
    suite = lambda df: [C.Check("v_not_null", build=lambda: C.not_null(df, "v"))]
    C.run_checks(spark, suite(bad), f"{scratch}/f", f"{scratch}/r")
    assert spark.read.parquet(f"{scratch}/f/v_not_null").count() == 1
    C.run_checks(spark, suite(good), f"{scratch}/f", f"{scratch}/r")
    assert not os.path.exists(f"{scratch}/f/v_not_null")
    assert sorted(r.status for r in spark.read.parquet(f"{scratch}/r").collect()) == ["fail", "pass"]


def test_first_increment_loads_everything_and_is_audited(spark, scratch):
    raw = load_raw(spark, SF)["reviews"]
    path, audit = f"{scratch}/fct", f"{scratch}/audit"
    incremental_fct_load(spark, raw.filter("date < '1998-04-01'"), path, audit_path=audit)
    incremental_fct_load(spark, raw, path, "1998-03-01 00:00:00", "1998-05-01 00:00:00", audit_path=audit)
    incremental_fct_load(spark, raw, path, audit_path=audit)
    full = M.fct_reviews(M.src_reviews(raw))
    assert spark.read.parquet(path).count() == full.count()
    rows = [r.rows_affected for r in spark.read.parquet(audit).orderBy("started_at").collect()]
    assert rows[0] == full.filter("review_date < '1998-04-01'").count() and len(rows) == 3 and all(rows)


def test_window_load_prunes_by_literal_months(spark):
    from lodgeflow.plans.jobs import _window
    plan = _window("1998-03-01 00:00:00", "1998-04-01 00:00:00")
    assert "1998-03" in str(plan) and "1998-04" in str(plan)


def test_incremental_window_reload_is_idempotent(spark, scratch):
    raw = load_raw(spark, SF)
    full = with_review_partition(M.fct_reviews(M.src_reviews(raw["reviews"])))
    path = f"{scratch}/fct"
    # first load: everything before April 1998
    write_table(full.filter(F.col("review_date") < "1998-04-01"), path, partition_by=[REVIEW_PARTITION])
    incremental_fct_load(spark, raw["reviews"], path, "1998-03-01 00:00:00", "1998-05-01 00:00:00")
    incremental_fct_load(spark, raw["reviews"], path, "1998-03-01 00:00:00", "1998-05-01 00:00:00")
    got = spark.read.parquet(path)
    expected = full.filter(F.col("review_date") < "1998-05-01")
    assert got.count() == expected.count()
    assert got.select("review_id").distinct().count() == got.count()
    # since-last mode picks up everything after the new high-water mark
    incremental_fct_load(spark, raw["reviews"], path)
    assert spark.read.parquet(path).count() == full.count()


def test_streaming_load_matches_batch(spark, scratch):
    raw = load_raw(spark, SF)["reviews"]
    landing = f"{scratch}/landing"
    raw.filter(F.col("date") < "1997-01-01").write.parquet(f"{landing}/part1")
    raw.filter(F.col("date") >= "1997-01-01").write.parquet(f"{landing}/part2")
    fct_path = f"{scratch}/fct_stream"
    q = start_review_load(spark, f"{landing}/*", fct_path, f"{scratch}/stream_ckpt")
    q.awaitTermination(300)
    got = spark.read.parquet(fct_path)
    expected = M.fct_reviews(M.src_reviews(raw))
    assert got.count() == expected.count()
    assert got.select("review_id").exceptAll(expected.select("review_id")).count() == 0


def test_read_calendar_and_declared_source(spark, scratch):
    p = f"{scratch}/moons.csv"
    with open(p, "w") as f:
        f.write("full_moon_date\n2009-01-11\n2009-02-09\n")
    cal = read_calendar(spark, p)
    assert [r[0] for r in cal.collect()] == [dt.date(2009, 1, 11), dt.date(2009, 2, 9)]
    raw = load_raw(spark, SF)["listings"]
    raw.write.parquet(f"{scratch}/listings")
    src = read_source(spark, "listings", f"{scratch}/listings")
    assert src.schema["price"].dataType.simpleString() == "string" and src.count() == raw.count()


def test_clustered_write(spark, scratch):
    df = spark.range(1000).select((F.col("id") % 7).alias("model"), F.col("id").alias("d"))
    write_table(df, f"{scratch}/c", cluster_by=["model", "d"])
    back = spark.read.parquet(f"{scratch}/c")
    assert back.count() == 1000


def test_profile_history_appends_once_per_day(spark, scratch):
    from lodgeflow.operators.profile import read_profile_history
    from lodgeflow.plans.jobs import PROFILED, run_profiles
    m = M.build_models(load_raw(spark, SF))
    hist = f"{scratch}/profiles"
    run_profiles(spark, m, hist, as_of="2024-01-03 10:00:00")
    run_profiles(spark, m, hist, as_of="2024-01-03 18:00:00")     # same day: skipped
    def runs(model):
        return read_profile_history(spark, f"{hist}/{model}")

    assert [runs(n).count() for n, _, _ in PROFILED] == [1] * 5
    run_profiles(spark, m, hist, as_of="2024-01-04 09:00:00")     # next day: appended
    assert [runs(n).count() for n, _, _ in PROFILED] == [2] * 5
    fct = runs("fct_reviews").select("data_type", "sample_percentage").distinct().collect()
    assert [(r.data_type, r.sample_percentage) for r in fct] == [("sampled", 50.0)]
    # each model keeps its own columns
    assert "is_superhost_mode" in runs("scd_raw_hosts").columns
    assert "price_mode" in runs("scd_raw_listings").columns and "price_mode" not in runs("scd_raw_hosts").columns


def test_profile_history_keeps_columns_that_come_and_go(spark, scratch):
    from lodgeflow.operators import profile as P
    a = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    for df, day in ((a, "2024-01-01"), (a.drop("a"), "2024-01-02"), (a, "2024-01-03")):
        P.write_profile_history(spark, f"{scratch}/p", P.profile_table(df, "m", as_of=f"{day} 00:00:00"))
    got = P.read_profile_history(spark, f"{scratch}/p").orderBy("profile_date").collect()
    assert [r["a_min"] for r in got] == [1.0, None, 1.0] and [r["b_min"] for r in got] == [2.0] * 3


def test_release_checkpoints_removes_scratch_tables(spark):
    from lodgeflow.session import path_exists, release_checkpoints, reliable_checkpoint
    release_checkpoints(spark)
    df = reliable_checkpoint(spark.range(10))
    assert df.count() == 10
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert path_exists(spark, path)
    assert release_checkpoints(spark) == 1
    assert not path_exists(spark, path)


def test_partitioned_rebuild_rebalances_and_replaces(spark, scratch):
    import glob
    df = spark.range(0, 20000, 1, 16).select((F.col("id") % 5).alias("p"), "id")
    path = f"{scratch}/t"
    write_table(df, path, partition_by=["p"])
    files = glob.glob(f"{path}/p=*/*.parquet")
    assert len({f.split("/")[-2] for f in files}) == 5
    assert len(files) < 16 * 5                 # not one file per writing task per partition
    write_table(df.filter("p < 2"), path, partition_by=["p"])   # full rebuild drops stale partitions
    assert sorted(r.p for r in spark.read.parquet(path).select("p").distinct().collect()) == [0, 1]
