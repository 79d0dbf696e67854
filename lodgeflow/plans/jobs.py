"""Ordered build run: snapshot → models → checks → audit.

A plain script replaces the reference's model-graph resolution: each materialised
table is written once, with an audit row, in dependency order, and whatever
comes after reads the written table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodgeflow.operators import checks as C
from lodgeflow.operators import profile as P
from lodgeflow.operators.commit import folders, recover
from lodgeflow.operators.load import (audited, audited_write, reconcile_schema, select_increment,
                                      write_delete_insert)
from lodgeflow.operators.scd2 import read_history, scd2_snapshot
from lodgeflow.plans import models as M
from lodgeflow.plans.suite import SCHEMA_TRACKED, full_suite
from lodgeflow.session import path_exists, release_checkpoints
from lodgeflow.sources.fixtures import load_raw
from lodgeflow.sources.raw import read_calendar, read_source

# Materialised models, in dependency order (views stay lazy).
TABLES = ("dim_listings_with_hosts", "fct_reviews", "mart_fullmoon_reviews",
          "price_sentiment_correlation", "review_sentiment_by_month",
          "new_listings_time_series")

REVIEW_PARTITION = "review_month"


def with_review_partition(fct: DataFrame) -> DataFrame:
    """Partition column of the fact. The review id hashes the review date, so
    a key always lives in one month partition: keyed reloads stay local."""
    return fct.withColumn(REVIEW_PARTITION, F.date_format("review_date", "yyyy-MM"))


def read_declared(spark: SparkSession, hosts: str, listings: str, reviews: str, calendar: str,
                  fmt: str = "parquet") -> dict[str, DataFrame]:
    """The declared sources (S1) and the CSV calendar (S2) from their paths."""
    return {"hosts": read_source(spark, "hosts", hosts, fmt), "listings": read_source(spark, "listings", listings, fmt),
            "reviews": read_source(spark, "reviews", reviews, fmt), "calendar": read_calendar(spark, calendar)}


def run_full_build(spark: SparkSession, raw: dict[str, DataFrame] | str, out_dir: str,
                   invocation_id: str | None = None, profile: bool = False,
                   as_of=None, stop_on_error: bool = False) -> DataFrame:
    """Build every table under ``out_dir``, audit each write, run the whole suite
    on the written tables (and, with ``profile``, append today's profiles).

    ``raw`` holds the frames hosts, listings, reviews and calendar
    (``read_declared``), or is a folder of the fixture tables. With
    ``stop_on_error`` a failed check of severity ``error`` raises.
    """
    invocation_id = invocation_id or uuid.uuid4().hex
    if isinstance(raw, str):
        raw = load_raw(spark, raw)
    audit = f"{out_dir}/_audit"
    for name, source in (("scd_raw_hosts", raw["hosts"]), ("scd_raw_listings", raw["listings"])):
        # history accumulates across builds; each build reads only what its keys hold
        audited(spark, name, audit,
                lambda n=name, src=source: scd2_snapshot(spark, f"{out_dir}/{n}", src, "id",
                                                          as_of=as_of, run_id=invocation_id),
                invocation_id)
    snapshots = {n: read_history(spark, f"{out_dir}/{n}") for n in ("scd_raw_hosts", "scd_raw_listings")}
    m = M.build_models(raw, snapshots["scd_raw_hosts"], snapshots["scd_raw_listings"])
    for name in TABLES:
        df, path, kw = m[name], f"{out_dir}/{name}", {}
        columns = df.columns
        if name == "fct_reviews":
            df, kw = with_review_partition(df), {"partition_by": [REVIEW_PARTITION]}
        audited_write(df, path, name, audit, invocation_id, **kw)
        m[name] = spark.read.parquet(path).select(*columns)  # later tables and checks read what was written
    if profile:
        run_profiles(spark, m, f"{out_dir}/_profiles", as_of=as_of)
    schemas = f"{out_dir}/_schemas"
    before = None
    if path_exists(spark, schemas):
        known = spark.read.parquet(schemas)
        before = known.filter(F.col("run_at") == known.select(F.max("run_at")).scalar()).drop("run_at")
    suite = full_suite(raw, m, snapshots, as_of, before)
    try:
        return C.run_checks(spark, suite, f"{out_dir}/_failures", f"{out_dir}/_check_results", invocation_id,
                            stop_on_error)
    finally:
        now = C.schema_snapshot(m[SCHEMA_TRACKED[0]], SCHEMA_TRACKED[0])
        for name in SCHEMA_TRACKED[1:]:
            now = now.unionByName(C.schema_snapshot(m[name], name))
        now.withColumn("run_at", F.localtimestamp()).coalesce(1).write.mode("append").parquet(schemas)


# The reference's profiled models: (model, date column, sample percent).
PROFILED = (("scd_raw_hosts", "updated_at", None), ("scd_raw_listings", "updated_at", None),
            ("dim_listings_with_hosts", "updated_at", None), ("fct_reviews", "review_date", 50),
            ("mart_fullmoon_reviews", "review_date", None))


def run_profiles(spark: SparkSession, models: dict[str, DataFrame], history_path: str,
                 as_of=None, env: str = "dev") -> None:
    """Profile every stored model once per day; each model has a history of its own."""
    for name, date_col, pct in PROFILED:
        row = P.profile_table(models[name], name, sample_pct=pct, date_col=date_col,
                              as_of=as_of, env=env, stored=pct is None)
        P.write_profile_history(spark, f"{history_path}/{name}", row)


def _window(start, end) -> Column:
    """Literal bounds of the fact's partitions that [start, end) touches."""
    return F.col(REVIEW_PARTITION).between(str(start)[:7], str(end)[:7])


def incremental_fct_load(spark: SparkSession, raw_reviews: DataFrame, fct_path: str,
                         start=None, end=None, audit_path: str | None = None) -> None:
    """The partitioned daily load: window (or since-last) increment → surrogate
    key → drift check (``fail``) → partition-local delete+insert. A first run
    loads everything. Both kinds of load prune the fact by literal month bounds; a
    since-last load reads the greatest date from the last month alone."""
    src = with_review_partition(M.fct_reviews(M.src_reviews(raw_reviews)))
    recover(spark, fct_path, drop_uncommitted=True)
    months = [m.split("=", 1)[1] for m in folders(spark, fct_path, f"{REVIEW_PARTITION}=")]
    target = spark.read.parquet(fct_path) if months else None
    partitions = None
    if target is None:
        batch = src
    elif start is not None and end is not None:
        batch = select_increment(src, target, "review_date", start, end)
        partitions = _window(start, end)
    else:
        # the greatest date lies in the last month; as a literal it prunes both sides
        last = max((m for m in months if not m.startswith("__HIVE")), default=None)
        newest = None if last is None else target.filter(F.col(REVIEW_PARTITION) == last).agg(
            F.max("review_date").cast("string")).first()[0]
        batch = src.filter(F.col("review_date") > F.lit(newest).cast("timestamp_ntz"))
        partitions = F.col(REVIEW_PARTITION) >= F.lit(str(newest)[:7])
    if target is not None:
        _, batch = reconcile_schema(target, batch, "fail")

    def load() -> int:
        seen = Observation(f"load_{uuid.uuid4().hex[:8]}")
        write_delete_insert(spark, fct_path, batch, "review_id", REVIEW_PARTITION, partitions, seen)
        return int(seen.get["rows"])

    if audit_path:
        audited(spark, "incremental_fct_reviews", audit_path, load)
    else:
        load()


def main(argv: list[str] | None = None) -> None:
    """``python -m lodgeflow.plans.jobs OUT_DIR (--tables DIR | --hosts P --listings P --reviews P --calendar CSV)``"""
    import argparse

    from lodgeflow.session import build_session

    ap = argparse.ArgumentParser(description="build the marketplace tables")
    ap.add_argument("out_dir")
    ap.add_argument("--tables", metavar="DIR", help="folder of the fixture tables instead of raw sources")
    for name in ("hosts", "listings", "reviews", "calendar"):
        ap.add_argument(f"--{name}", metavar="PATH")
    ap.add_argument("--format", default="parquet", help="format of the raw sources")
    ap.add_argument("--profile", action="store_true", help="append today's profiles")
    ap.add_argument("--stop-on-error", action="store_true", help="fail when a check of severity error fails")
    ap.add_argument("--only-increment", action="store_true", help="load new reviews, build nothing else")
    ap.add_argument("--reload", nargs=2, metavar=("START", "END"),
                    help="reload reviews in [START, END); without it an increment loads what is newer")
    a = ap.parse_args(argv)
    spark = build_session()
    raw = load_raw(spark, a.tables) if a.tables else read_declared(
        spark, a.hosts, a.listings, a.reviews, a.calendar, a.format)
    if not a.only_increment:
        run_full_build(spark, raw, a.out_dir, profile=a.profile, stop_on_error=a.stop_on_error
                       ).show(200, truncate=False)
    if a.reload or a.only_increment:
        incremental_fct_load(spark, raw["reviews"], f"{a.out_dir}/fct_reviews", *(a.reload or ()),
                             audit_path=f"{a.out_dir}/_audit")
    release_checkpoints(spark)


if __name__ == "__main__":
    main()
