"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables — through the fixture mapping
(``sources.fixtures``) where the marketplace's raw tables are needed, directly
for ``events`` and the lineage graph — and runs the library operator over the
whole tables.
Outputs are normalised to the types both Spark and DuckDB produce
(decimals → double, small integers → bigint) so the oracle can hash them.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeflow.functions.columns import day_diff
from lodgeflow.operators import anomaly, checks, frequent, lineage, load, profile, profile_store, quantiles, scd2
from lodgeflow.plans import models as M
from lodgeflow.plans.jobs import REVIEW_PARTITION, incremental_fct_load, with_review_partition
from lodgeflow.plans.suite import PRICE_REGEX, ROOM_TYPES, SENTIMENTS
from lodgeflow.sources.fixtures import load_raw, table
from lodgeflow.session import ensure_checkpoint_dir, reliable_checkpoint
from lodgeflow.sources.raw import moon_calendar, read_calendar, read_source

# Fixed parameters of the registered scenarios.
SINCE_LAST_TARGET_END = "1998-01-01 00:00:00"
WINDOW = ("1998-03-01 00:00:00", "1998-04-01 00:00:00")
DELETE_INSERT_TARGET_END = "1998-06-01 00:00:00"
DELETE_INSERT_BATCH = ("1998-05-01 00:00:00", "1998-07-01 00:00:00")
MERGE_TARGET_LOADED = "2024-01-01 00:00:00"
MERGE_BATCH_LOADED = "2024-02-01 00:00:00"
SCD_AS_OF = "2002-01-01 00:00:00"
SCD_VIEW_AT = "2001-06-15 00:00:00"
FRESHNESS_AS_OF = "2001-11-06 12:00:00"
ANOMALY_AS_OF = "2024-01-31 00:00:00"
LINEAGE_AS_OF = "2024-01-01 00:00:00"
LISTING_URL_REGEX = r"^https://example\.com/rooms/[0-9]+$"


# whole numbers that a long cannot hold; a double would round them
WIDE_WHOLE = T.DecimalType(38, 0)


def normalise(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)) and f.dataType != WIDE_WHOLE:
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _models(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return M.build_models(load_raw(spark, sf))


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: _models(spark, sf)[name]


# --- scenario inputs ---------------------------------------------------------
def listings_second_version(raw_listings: DataFrame) -> DataFrame:
    """Second snapshot of the listings (FIXTURES §2): hard deletes, newer
    versions, ignored same-timestamp edits and new keys."""
    k = F.col("id")
    changed = raw_listings.filter(k % 17 != 0).select(
        "id", "listing_url", "name", "room_type", "minimum_nights", "host_id",
        F.when(k % 10 == 0, F.lit("$1.00")).when(k % 7 == 0, F.lit("$2.00"))
         .otherwise(F.col("price")).alias("price"),
        "created_at",
        F.when(k % 10 == 0, F.col("updated_at") + F.expr("INTERVAL 30 DAYS"))
         .otherwise(F.col("updated_at")).alias("updated_at"))
    top = raw_listings.select(F.max("id")).scalar()
    new = raw_listings.filter(k % 101 == 0).withColumn("id", k + top + 1)
    return changed.unionByName(new.select(*changed.columns))


def scd_listings_history(spark: SparkSession, sf: str) -> DataFrame:
    raw = load_raw(spark, sf)["listings"]
    h1 = scd2.scd2_apply(None, raw, "id")
    return scd2.scd2_apply(h1, listings_second_version(raw), "id", as_of=SCD_AS_OF)


def _fct(spark, sf):
    return _models(spark, sf)["fct_reviews"]


def _daily(df: DataFrame, ts: str, loaded_at: str) -> DataFrame:
    return (df.groupBy(F.to_date(ts).alias("review_day"))
            .agg(F.count(F.lit(1)).alias("reviews"))
            .select("review_day", "reviews", F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at")))


def q_increment_since_last(spark, sf):
    fct = _fct(spark, sf)
    target = fct.filter(F.col("review_date") < F.lit(SINCE_LAST_TARGET_END).cast("timestamp_ntz"))
    return load.select_increment(fct, target, "review_date")


def q_increment_window(spark, sf):
    fct = _fct(spark, sf)
    # the existing table: everything before the window; the window is reloaded
    target = fct.filter(F.col("review_date") < F.lit(WINDOW[0]).cast("timestamp_ntz"))
    return load.select_increment(fct, target, "review_date", *WINDOW)


def _late_target(fct: DataFrame) -> DataFrame:
    """The fact as a since-last load has left it: without rows that came late, with texts that
    have changed since and with rows that the source has dropped."""
    day, key = F.dayofmonth("review_date"), F.col("listing_id")
    loaded = fct.filter(F.col("review_date") < F.lit(SINCE_LAST_TARGET_END).cast("timestamp_ntz"))
    kept = loaded.filter(~((day == 5) & (key % 37 == 0)))
    old = kept.withColumn("review_sentiment", F.when((day == 9) & (key % 41 == 0), F.upper("review_sentiment"))
                          .otherwise(F.col("review_sentiment")))
    dropped = loaded.filter((day == 11) & (key % 43 == 0)).withColumn("review_text", F.lit("dropped by the source"))
    return old.unionByName(dropped)


def q_increment_changed_days(spark, sf):
    """Rows on the days that differ between source and target, found by day checksums."""
    fct = _fct(spark, sf)
    return load.select_changed_days(fct, _late_target(fct), "review_date")[0]


def q_changed_days_table(spark, sf):
    """The target after the checksum load: it equals the source again."""
    fct = with_review_partition(_fct(spark, sf))
    path = _scratch(spark, "fct")
    load.write_table(with_review_partition(_late_target(_fct(spark, sf))), path, partition_by=[REVIEW_PARTITION])
    load.write_changed_days(spark, path, fct, "review_date", REVIEW_PARTITION)
    return spark.read.parquet(path).drop(REVIEW_PARTITION)


def _scratch(spark: SparkSession, kind: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


# --- sinks and sources: written, read back --------------------------------------------
def q_sink_full_rebuild(spark, sf):
    """The fact written twice over, partitioned by month."""
    path, fct = _scratch(spark, "w1"), with_review_partition(_fct(spark, sf))
    load.write_table(fct.filter(F.col("listing_id") % 2 == 0), path, partition_by=[REVIEW_PARTITION])
    load.write_table(fct, path, partition_by=[REVIEW_PARTITION])
    return spark.read.parquet(path).withColumn(REVIEW_PARTITION, F.col(REVIEW_PARTITION).cast("string"))


def q_sink_since_last(spark, sf):
    """A first load of older reviews, then a since-last load of all."""
    path, raw = _scratch(spark, "w3"), load_raw(spark, sf)["reviews"]
    before = F.col("date") < F.lit(SINCE_LAST_TARGET_END).cast("timestamp_ntz")
    incremental_fct_load(spark, raw.filter(before), path)
    incremental_fct_load(spark, raw, path)
    return spark.read.parquet(path).drop(REVIEW_PARTITION)


def q_sink_schema_drift(spark, sf):
    """A batch with a new and without an old column, under each policy that goes on."""
    m = _models(spark, sf)["dim_hosts_cleansed"]
    target, batch = m.filter("host_id % 2 = 0"), m.filter("host_id % 2 = 1").withColumn(
        "name_length", F.length("host_name").cast("bigint")).drop("is_superhost")
    out = None
    for policy in ("ignore", "append_new_columns", "sync_all_columns"):
        path = _scratch(spark, "w6")
        old, new = load.reconcile_schema(target, batch, policy)
        load.write_table(old.unionByName(new), path)
        back = spark.read.parquet(path)
        has = lambda c: F.count(c) if c in back.columns else F.lit(-1)  # noqa: E731, B023
        row = back.agg(F.lit(policy).alias("policy"), F.count(F.lit(1)).alias("rows"), F.count("host_name").alias("names"),
                       has("is_superhost").cast("bigint").alias("superhosts"), has("name_length").cast("bigint").alias("lengths"))
        out = row if out is None else out.unionByName(row)
    return out


def q_sink_clustered(spark, sf):
    """Listings clustered by range, and reviews on an interleaved key of two columns."""
    listings, reviews = _scratch(spark, "w8"), _scratch(spark, "w8z")
    load.write_table(_models(spark, sf)["dim_listings_cleansed"], listings, cluster_by=["host_id", "listing_id"])
    load.write_table(_fct(spark, sf), reviews, zorder_by=["listing_id", "review_date"])
    per = lambda path, name, key: spark.read.parquet(path).agg(
        F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"),
        F.sum("listing_id").alias("total"))
    return per(listings, "listings", "listing_id").unionByName(per(reviews, "reviews", "review_id"))


def q_sink_checks(spark, sf):
    """Checks run as one job; results and failing rows stored and read back."""
    raw = load_raw(spark, sf)
    m, path = M.build_models(raw), _scratch(spark, "w9")
    nights = F.col("minimum_nights")
    suite = [checks.Check("one_listing_per_host", lambda: checks.unique(raw["listings"], "host_id"), "warn", "listings"),
             checks.Check("positive_host", lambda: checks.positive_value(raw["listings"], "host_id"), "error", "listings"),
             checks.Check("long_stay", lambda: m["dim_listings_cleansed"].filter(nights > 20), "error", "dim_listings",
                          failing=nights > 20, frame=lambda: m["dim_listings_cleansed"]),
             checks.Check("no_stay", lambda: m["dim_listings_cleansed"].filter(nights < 1), "error", "dim_listings",
                          failing=nights < 1, frame=lambda: m["dim_listings_cleansed"])]
    checks.run_checks(spark, suite, f"{path}/failures", f"{path}/results", "run")
    stored = None
    for name in ("one_listing_per_host", "long_stay"):
        one = spark.read.parquet(f"{path}/failures/{name}").agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("stored"))
        stored = one if stored is None else stored.unionByName(one)
    results = spark.read.parquet(f"{path}/results").drop("run_at")
    return results.join(stored, "check_name", "left")


def q_sink_audit(spark, sf):
    """Audit rows of two writes, one of which fails."""
    path, hosts = _scratch(spark, "w10"), load_raw(spark, sf)["hosts"]
    load.audited_write(hosts, f"{path}/hosts", "hosts", f"{path}/audit", "run")
    try:
        load.audited_write(hosts, f"{path}/hosts", "again", f"{path}/audit", "run", mode="errorifexists")
    except AnalysisException:  # the table is there: recorded and raised
        pass
    audit = spark.read.parquet(f"{path}/audit")
    return audit.select("invocation_id", "step", "status", "rows_affected",
                        (F.col("execution_seconds") >= 0).alias("timed"), F.col("error").isNotNull().alias("failed"))


MOON_YEAR = 1997


def q_sources_declared(spark, sf):
    """Raw tables and calendar written as JSON and CSV, read by their declared schemas
    (of the calendar the moons of one year, as its span follows the data's own dates)."""
    path, raw = _scratch(spark, "raw"), load_raw(spark, sf)
    out = None
    for name in ("hosts", "listings", "reviews"):
        raw[name].withColumn("undeclared", F.lit(1)).write.json(f"{path}/{name}")
        back = read_source(spark, name, f"{path}/{name}", "json")
        one = back.agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("rows"),
                       *[F.count(c).alias(f"c{i}") for i, c in enumerate(back.columns[:5])],
                       F.max(back.columns[1 if name == "reviews" else 3]).cast("string").alias("greatest"))
        out = one if out is None else out.unionByName(one)
    moon_calendar(raw["reviews"].select(F.to_date("date").alias("day"))).write.option("header", True).csv(f"{path}/moon")
    moons = read_calendar(spark, f"{path}/moon").filter(F.year("full_moon_date") == MOON_YEAR).agg(
        F.lit("calendar").alias("source"), F.count(F.lit(1)).alias("rows"), F.count("full_moon_date").alias("c0"),
        *[F.lit(None).cast("bigint").alias(f"c{i}") for i in range(1, 5)], F.max("full_moon_date").cast("string").alias("greatest"))
    return out.unionByName(moons)


def _delete_insert_inputs(spark, sf):
    fct = _fct(spark, sf)
    target = fct.filter(F.col("review_date") < F.lit(DELETE_INSERT_TARGET_END).cast("timestamp_ntz"))
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in DELETE_INSERT_BATCH)
    batch = (fct.filter((F.col("review_date") >= lo) & (F.col("review_date") < hi))
             .withColumn("review_sentiment", F.upper("review_sentiment")))
    return target, batch


def q_delete_insert(spark, sf):
    target, batch = _delete_insert_inputs(spark, sf)
    return load.delete_insert(target, batch, "review_id")


def _merge_inputs(spark, sf):
    raw = load_raw(spark, sf)
    fct = M.fct_reviews(M.src_reviews(raw["reviews"]))
    target = _daily(fct.filter(F.col("review_date") < F.lit(DELETE_INSERT_TARGET_END)
                               .cast("timestamp_ntz")), "review_date", MERGE_TARGET_LOADED)
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in DELETE_INSERT_BATCH)
    rv = raw["reviews"]
    batch = _daily(rv.filter((F.col("date") >= lo) & (F.col("date") < hi)), "date",
                   MERGE_BATCH_LOADED)
    return target, batch


def q_merge_upsert(spark, sf):
    target, batch = _merge_inputs(spark, sf)
    return load.merge_upsert(target, batch, "review_day", exclude_update=["loaded_at"])


def q_skip_existing(spark, sf):
    target, batch = _merge_inputs(spark, sf)
    return load.skip_existing(batch, target, "review_day")


# --- checks ----------------------------------------------------------------------------
def _check(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf):
        raw = load_raw(spark, sf)
        m = M.build_models(raw)
        return fn(raw, m)
    return run


CHECKS: dict[str, Callable] = {
    "check_unique_listing_id": lambda r, m: checks.unique(m["dim_listings_cleansed"], "listing_id"),
    "check_unique_review_id": lambda r, m: checks.unique(m["fct_reviews"], "review_id"),
    "check_not_null_host_name": lambda r, m: checks.not_null(r["hosts"], "name"),
    "check_accepted_room_type": lambda r, m: checks.accepted_values(
        m["dim_listings_cleansed"], "room_type", ROOM_TYPES),
    "check_accepted_sentiment": lambda r, m: checks.accepted_values(
        r["reviews"], "sentiment", SENTIMENTS),
    "check_relationships_listing_host": lambda r, m: checks.relationships(
        r["listings"], "host_id", r["hosts"], "id"),
    "check_relationships_review_listing": lambda r, m: checks.relationships(
        r["reviews"], "listing_id", r["listings"], "id"),
    "check_positive_host_id": lambda r, m: checks.positive_value(r["listings"], "host_id"),
    "check_null_pct_host_name": lambda r, m: checks.null_percentage(r["hosts"], "name", 5),
    "check_null_pct_comments": lambda r, m: checks.null_percentage(r["reviews"], "comments", 5),
    "check_zero_pct_min_nights": lambda r, m: checks.value_percentage(
        r["listings"], "minimum_nights", 0, 5),
    "check_joint_null_pct_reviews": lambda r, m: checks.null_percentage(
        m["fct_reviews"], ["review_text", "review_sentiment"], 5),
    "check_price_parseable": lambda r, m: checks.parseable_positive(r["listings"], "price"),
    "check_superhost_parseable": lambda r, m: checks.parseable_boolean(r["hosts"], "is_superhost"),
    "check_no_nulls_dim_hosts": lambda r, m: checks.no_nulls(m["dim_hosts_cleansed"]),
    "check_no_nulls_dim_listings_with_hosts": lambda r, m: checks.no_nulls(
        m["dim_listings_with_hosts"]),
    "check_missing_months": lambda r, m: checks.missing_months(
        m["new_listings_time_series"], "listing_month", m["dim_listings_cleansed"], "created_at"),
    "check_created_after_review": lambda r, m: checks.created_after_review(
        m["dim_listings_cleansed"], m["fct_reviews"]),
    "check_min_nights_sample": lambda r, m: checks.sample_failures(
        m["dim_listings_cleansed"], F.col("minimum_nights") < 1, 10, ["listing_id"]),
    "check_between_new_listings": lambda r, m: checks.between(
        m["new_listings_time_series"], "new_listings", min_value=0),
    "check_max_price": lambda r, m: checks.agg_between(
        m["dim_listings_with_hosts"], "price", "max", max_value=5000),
    "check_min_min_nights": lambda r, m: checks.agg_between(
        r["listings"], "minimum_nights", "min", min_value=0),
    "check_p99_price": lambda r, m: checks.quantile_between(
        m["dim_listings_with_hosts"], "price", 0.99, 50, 500),
    "check_freshness_reviews": lambda r, m: checks.freshness(
        r["reviews"], "date", FRESHNESS_AS_OF, 1, 24),
    "check_distinct_sentiment": lambda r, m: checks.distinct_count_equals(r["reviews"], "sentiment", 3),
    "check_distinct_room_type": lambda r, m: checks.distinct_count_equals(r["listings"], "room_type", 4),
    "check_distinct_superhost": lambda r, m: checks.distinct_count_equals(r["hosts"], "is_superhost", 2),
    "check_row_count_listings": lambda r, m: checks.row_count_equals(
        m["dim_listings_with_hosts"], r["listings"]),
    "check_regex_listing_url": lambda r, m: checks.matches_regex(
        r["listings"], "listing_url", LISTING_URL_REGEX),
    "check_regex_price": lambda r, m: checks.matches_regex(r["listings"], "price", PRICE_REGEX),
}

# The same checks on data or limits that they must object to: each returns rows.
VIOLATED: dict[str, Callable] = {
    "violated_unique": lambda r, m: checks.unique(r["reviews"], "listing_id"),
    "violated_accepted_values": lambda r, m: checks.accepted_values(
        m["dim_listings_cleansed"], "room_type", ["Private room"]),
    "violated_zero_pct": lambda r, m: checks.value_percentage(r["listings"], "minimum_nights", 0, 1),
    "violated_null_pct": lambda r, m: checks.null_percentage(r["hosts"], "name", 1),
    "violated_joint_null_pct": lambda r, m: checks.null_percentage(
        _nulled(m["fct_reviews"]), ["review_text", "review_sentiment"], 5),
    "violated_price_parses": lambda r, m: checks.parseable_positive(r["listings"], "room_type"),
    "violated_boolean_parses": lambda r, m: checks.parseable_boolean(r["hosts"], "name"),
    "violated_no_nulls": lambda r, m: checks.no_nulls(r["hosts"]),
    "violated_missing_months": lambda r, m: checks.missing_months(
        m["new_listings_time_series"].filter(F.month("listing_month") != 3), "listing_month",
        m["dim_listings_cleansed"], "created_at"),
    "violated_sample": lambda r, m: checks.sample_failures(
        m["dim_listings_cleansed"], F.col("minimum_nights") < 5, 10, ["listing_id"]),
    "violated_between": lambda r, m: checks.between(
        m["new_listings_time_series"], "new_listings", min_value=1, max_value=30),
    "violated_max": lambda r, m: checks.agg_between(m["dim_listings_with_hosts"], "price", "max", max_value=100),
    "violated_min": lambda r, m: checks.agg_between(r["listings"], "minimum_nights", "min", min_value=1),
    "violated_quantile": lambda r, m: checks.quantile_between(m["dim_listings_with_hosts"], "price", 0.99, 50, 100),
    "violated_distinct_count": lambda r, m: checks.distinct_count_equals(r["listings"], "room_type", 3),
    "violated_row_count": lambda r, m: checks.row_count_equals(m["dim_listings_with_hosts"], r["hosts"]),
    "violated_regex": lambda r, m: checks.matches_regex(r["listings"], "listing_url", PRICE_REGEX),
    "violated_relationships": lambda r, m: checks.relationships(
        r["reviews"], "listing_id", r["listings"].filter(F.col("id") % 9 != 0), "id"),
}


def _nulled(fct: DataFrame) -> DataFrame:
    """Reviews of which every tenth listing's lack text and sentiment."""
    gone = F.col("listing_id") % 10 == 0
    return fct.withColumns({c: F.when(~gone, F.col(c)) for c in ("review_text", "review_sentiment")})


def q_violated_single_active(spark, sf):
    h = scd_listings_history(spark, sf)
    return scd2.single_active_version(h.unionByName(h.filter("valid_to IS NULL AND id % 13 = 0")), "id")


def q_violated_volume(spark, sf):
    """Events of which the 20th of a month keeps a tenth."""
    events = table(spark, sf, "events").filter((F.dayofmonth("ts") != 20) | (F.col("event_id") % 10 == 0))
    return anomaly.volume_anomalies(events, "ts", as_of=ANOMALY_AS_OF, detection_delay_days=1,
                                    spike_pct=10, drop_pct=5)


# --- further scenarios ---------------------------------------------------------------
def q_price_by_sentiment_nulls(spark, sf):
    """Price statistics where some reviews lack a sentiment and some listings a price."""
    m = _models(spark, sf)
    mart = m["mart_fullmoon_reviews"].withColumn(
        "review_sentiment", F.when(F.col("listing_id") % 5 != 0, F.col("review_sentiment")))
    listings = m["dim_listings_cleansed"].withColumn("price", F.when(F.col("listing_id") % 3 != 0, F.col("price")))
    return M.price_sentiment_correlation(mart, listings)


SNAPSHOT_RUNS = ("2002-01-01 00:00:00", "2002-02-01 00:00:00", "2002-03-01 00:00:00")


def q_scd2_snapshot_table(spark, sf):
    """Three runs of the table sink: first snapshot; changes, deletes and new keys; the
    first snapshot again, so that deleted keys come back with their old date."""
    raw = load_raw(spark, sf)["listings"]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scd2-{uuid.uuid4().hex}"
    for source, at in zip((raw, listings_second_version(raw), raw), SNAPSHOT_RUNS):
        scd2.scd2_snapshot(spark, path, source, "id", as_of=at)
    return scd2.read_history(spark, path).drop("closed_run", "scd_id")


def listing_feed(raw_listings: DataFrame, run: int) -> DataFrame:
    """A change feed over the listings. Run 1: three versions of every tenth listing. Run 2: a
    later version of every fifth, versions that are known or too old, and new listings of
    two versions each."""
    k, day = F.col("id"), lambda n: F.col("updated_at") + F.expr(f"INTERVAL {n} DAYS")

    def version(of: DataFrame, days: int, price: str) -> DataFrame:
        return of.withColumns({"updated_at": day(days), "price": F.lit(price)})

    tenth = raw_listings.filter(k % 10 == 0)
    if run == 1:
        parts = [version(tenth, n, f"${n}.00") for n in (2, 1, 3)]
    else:
        new = raw_listings.filter(k % 101 == 0).withColumn("id", k + raw_listings.select(F.max("id")).scalar() + 1)
        parts = [version(raw_listings.filter(k % 5 == 0), 5, "$9.00"), version(tenth, 2, "$0.50"),
                 version(raw_listings.filter(k % 7 == 0), -1, "$0.25"), new, version(new, 1, "$7.00")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p.select(*out.columns))
    return out


def q_scd2_feed(spark, sf):
    """Three runs: all listings, then two change feeds with several versions of a key."""
    raw = load_raw(spark, sf)["listings"]
    history = scd2.scd2_feed(None, raw, "id")
    for run in (1, 2):
        history = reliable_checkpoint(scd2.scd2_feed(history, listing_feed(raw, run), "id"))
    return history.drop("scd_id")


def q_late_calendar(spark, sf):
    """Full-moon flags of reviews moved twenty years on."""
    reviews = load_raw(spark, sf)["reviews"].withColumn("date", F.col("date") + F.expr("INTERVAL 20 YEARS"))
    fct = M.fct_reviews(M.src_reviews(reviews))
    calendar = moon_calendar(reviews.select(F.to_date("date").alias("day")))
    return M.fullmoon_sentiment(M.mart_fullmoon_reviews(fct, calendar))


def q_lineage_nations(spark, sf):
    """A graph of model size with its name lists, most critical first: region → nation →
    customer segment of the nation; one segment's nodes are left out by pattern."""
    nation, customer = table(spark, sf, "nation"), table(spark, sf, "customer")
    named = F.concat(F.lit("nation_"), F.col("n_name"))
    edges = nation.select(F.concat(F.lit("region_"), F.col("n_regionkey").cast("string")).alias("parent"),
                          named.alias("child")).unionByName(
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            named.alias("parent"), F.concat_ws("_", F.lit("segment"), "c_mktsegment", "n_name").alias("child")).distinct())
    nodes = edges.select(F.col("parent").alias("name")).union(edges.select("child")).distinct()
    return lineage.order_impact(lineage.impact(edges, nodes, ["segment_BUILDING"], with_lists=True,
                                               as_of=LINEAGE_AS_OF))


# --- profiler ---------------------------------------------------------------------------
def _lwh(spark, sf):
    return _models(spark, sf)["dim_listings_with_hosts"]


def _col_profile(spark, sf, *families, numeric=False):
    # only the columns of the wanted families are read; numeric moments and
    # percentiles only where the query reports them
    return profile.column_profile(_lwh(spark, sf), numeric=numeric, families=families or None)


def q_profile_rows(spark, sf):
    # the fact is a projection of its table: reading it again costs less than storing it
    t = profile.table_metrics(_fct(spark, sf), stored=True)
    return t.select("total_rows", "distinct_rows", "duplicate_rate")


def q_profile_numeric(spark, sf):
    p = _col_profile(spark, sf, "numeric", numeric=True)
    return p.select("column_name", "min", "max", F.round("avg", 6).alias("avg"),
                    F.round("stddev", 6).alias("stddev"), F.round("variance", 2).alias("variance"),
                    F.round("p25", 6).alias("p25"), F.round("median", 6).alias("median"),
                    F.round("p75", 6).alias("p75"), "outlier_count")


def q_profile_string(spark, sf):
    p = _col_profile(spark, sf, "string")
    return p.select("column_name", "min_length", "max_length",
                    F.round("avg_length", 6).alias("avg_length"), "mode", "empty_count",
                    "whitespace_only_count", "numeric_pattern_count", "alpha_pattern_count")


def q_profile_dates(spark, sf):
    p = _col_profile(spark, sf, "temporal")
    return p.select("column_name", "earliest", "latest",
                    day_diff(F.to_date("earliest"), F.to_date("latest")).alias("date_range_days"),
                    "distinct_dates",
                    F.round(F.col("total_rows") / F.nullif(F.col("distinct_dates"), F.lit(0)), 2)
                    .alias("records_per_day_avg"))


def q_profile_boolean(spark, sf):
    p = _col_profile(spark, sf, "boolean")
    return p.select("column_name", "true_count", "false_count")


def q_profile_quality(spark, sf):
    return _col_profile(spark, sf).select(
        "column_name", "null_count", "distinct_count", "completeness_rate", "uniqueness_rate",
        "cardinality_category")


def q_profile_wide(spark, sf):
    """The whole table's wide row, without the engine's version."""
    wide = profile.profile_table(_fct(spark, sf), "fct_reviews", date_col="review_date",
                                 as_of=FRESHNESS_AS_OF, stored=True).drop("engine_version")
    digits = {f"listing_id_{m}": 6 for m in ("avg", "stddev", "p25", "median", "p75")} | {"listing_id_variance": 2} | {
        f"{c}_avg_length": 6 for c in ("review_id", "reviewer_name", "review_text", "review_sentiment")}
    return wide.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in wide.columns])


# beyond the whole numbers a double can hold; different for every order
BIG_FACTOR, BIG_BASE = 10_000_000_000_001, 9_007_199_254_740_993


def q_profile_big_integers(spark, sf):
    """Bounds and quartiles of whole numbers beyond 2^53, to the last digit: long, as in the
    SQL, while the greatest fits one, else decimal(38,0)."""
    key, factor, base = (F.col("l_orderkey").cast("decimal(19,0)"), F.lit(BIG_FACTOR).cast("decimal(14,0)"),
                         F.lit(BIG_BASE).cast("decimal(16,0)"))  # holds every long key
    big = table(spark, sf, "lineitem").select((key * factor + base).alias("big"))
    bounds = profile.column_profile(big, numeric=False, stored=True)
    values = reliable_checkpoint(big.select(F.lit("big").alias("g"), F.col("big").alias("x"), F.lit(1).cast("bigint").alias("w")))
    least, greatest = values.agg(F.min("x"), F.max("x")).first()
    fits = least is None or -(1 << 63) <= least and greatest < 1 << 63
    kind = T.LongType() if fits else WIDE_WHOLE
    ranks = quantiles.select_ranks(values, profile.PERCENTILES)
    lower = [F.max(F.when(F.col("k") == F.floor(F.lit(p) * (F.col("n") - 1)), F.col("value"))).cast(kind).alias(name)
             for p, name in zip(profile.PERCENTILES, ("p25_low", "median_low", "p75_low"))]
    return bounds.select("column_name", F.col("min_exact").cast(kind).alias("min"), F.col("max_exact").cast(kind).alias("max"),
                         "distinct_count").join(ranks.groupBy(F.col("g").alias("column_name")).agg(*lower), "column_name")


STORE_FIRST_RUN_END = "1997-01"


def q_profile_incremental(spark, sf):
    """The review fact's profile from a store of mergeable partition profiles: a first run over
    the months before ``STORE_FIRST_RUN_END``, a second one that adds only the rest."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/profiled-{uuid.uuid4().hex}"
    load.write_table(with_review_partition(_fct(spark, sf)), f"{folder}/fct", partition_by=[REVIEW_PARTITION])
    fct = spark.read.parquet(f"{folder}/fct")
    store, month = f"{folder}/store", F.col(REVIEW_PARTITION)
    profile_store.profile_new_partitions(spark, store, fct.filter(month < STORE_FIRST_RUN_END), REVIEW_PARTITION, "1")
    profile_store.profile_new_partitions(spark, store, fct, REVIEW_PARTITION, "2")
    runs = spark.read.parquet(store).groupBy("column_name").agg(
        F.count_if(F.col("run") == "1").alias("first_run_months"), F.count_if(F.col("run") == "2").alias("second_run_months"))
    merged = profile_store.merged_profile(spark, store, fct).select(
        "column_name", "total_rows", "null_count", "completeness_rate", "cardinality_category",
        "min_length", "max_length", F.round("avg_length", 6).alias("avg_length"), F.round("avg", 6).alias("avg"),
        F.when(F.col("family") == "numeric", F.col("min_exact")).cast("bigint").alias("min"),
        F.when(F.col("family") == "numeric", F.col("max_exact")).cast("bigint").alias("max"))
    return merged.join(runs, "column_name")


def q_column_modes(spark, sf):
    """Most frequent value and its count per text column of the reviews."""
    return frequent.exact_modes(_fct(spark, sf), ["review_id", "reviewer_name", "review_text", "review_sentiment"])


def q_sample_hash(spark, sf):
    return profile.sample_rows(load_raw(spark, sf)["listings"], 50, method="hash", key="id")


def q_sample_bernoulli(spark, sf):
    # random by design (fixed seed): rows-only in the oracle
    return profile.sample_rows(load_raw(spark, sf)["listings"], 50, seed=42)


# --- anomalies ---------------------------------------------------------------------------
def q_volume_scores(spark, sf):
    return anomaly.anomaly_scores(table(spark, sf, "events"), "ts")


def q_volume_anomalies(spark, sf):
    return anomaly.volume_anomalies(table(spark, sf, "events"), "ts", as_of=ANOMALY_AS_OF,
                                    detection_delay_days=1, spike_pct=10, drop_pct=5)


def q_dimension_scores(spark, sf):
    return anomaly.anomaly_scores(table(spark, sf, "events"), "ts", ["event_type"])


def q_dimension_anomalies(spark, sf):
    return anomaly.dimension_anomalies(table(spark, sf, "events"), "ts", ["event_type"],
                                       spike_pct=3, drop_pct=3)


# --- lineage -------------------------------------------------------------------------------
def dependency_edges(spark: SparkSession, sf: str) -> DataFrame:
    """A dependency graph derived from the data: customer → order → part."""
    o = table(spark, sf, "orders").select(
        F.concat(F.lit("customer#"), F.col("o_custkey").cast("string")).alias("parent"),
        F.concat(F.lit("order#"), F.col("o_orderkey").cast("string")).alias("child"))
    li = table(spark, sf, "lineitem").select(
        F.concat(F.lit("order#"), F.col("l_orderkey").cast("string")).alias("parent"),
        F.concat(F.lit("part#"), F.col("l_partkey").cast("string")).alias("child"))
    return o.unionByName(li)


def q_lineage_impact(spark, sf):
    return lineage.impact(dependency_edges(spark, sf), as_of=LINEAGE_AS_OF)


def cyclic_edges(spark: SparkSession, sf: str) -> DataFrame:
    """A graph with cycles derived from the data: a customer and their orders depend on each
    other, parts on orders."""
    forth = dependency_edges(spark, sf)
    back = table(spark, sf, "orders").select(
        F.concat(F.lit("order#"), F.col("o_orderkey").cast("string")).alias("parent"),
        F.concat(F.lit("customer#"), F.col("o_custkey").cast("string")).alias("child"))
    return forth.unionByName(back)


def q_lineage_cycles(spark, sf):
    return lineage.impact(cyclic_edges(spark, sf), as_of=LINEAGE_AS_OF, condense=True)


# --- the table -------------------------------------------------------------------------------
def _scd(fn):
    return lambda spark, sf: fn(scd_listings_history(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "price_by_sentiment": _model("price_sentiment_correlation"),
    "fullmoon_sentiment": lambda s, sf: M.fullmoon_sentiment(_models(s, sf)["mart_fullmoon_reviews"]),
    "sentiment_by_month": _model("review_sentiment_by_month"),
    "new_listings_monthly": _model("new_listings_time_series"),
    "listing_distribution": _model("dim_listings_with_hosts_distribution_analysis"),
    "price_histogram": lambda s, sf: M.price_histogram(
        _models(s, sf)["dim_listings_with_hosts_distribution_analysis"]),
    "superhost_ratio": lambda s, sf: M.superhost_ratio(_models(s, sf)["dim_listings_with_hosts"]),
    "dim_hosts": _model("dim_hosts_cleansed"),
    "dim_listings": _model("dim_listings_cleansed"),
    "dim_listings_with_hosts": _model("dim_listings_with_hosts"),
    "fct_reviews": _model("fct_reviews"),
    "mart_fullmoon_reviews": _model("mart_fullmoon_reviews"),
    "increment_since_last": q_increment_since_last,
    "increment_window": q_increment_window,
    "increment_changed_days": q_increment_changed_days,
    "changed_days_table": q_changed_days_table,
    "scd2_feed": q_scd2_feed,
    "sink_full_rebuild": q_sink_full_rebuild,
    "sink_since_last": q_sink_since_last,
    "sink_schema_drift": q_sink_schema_drift,
    "sink_clustered": q_sink_clustered,
    "sink_checks": q_sink_checks,
    "sink_audit": q_sink_audit,
    "sources_declared": q_sources_declared,
    "delete_insert": q_delete_insert,
    "merge_upsert": q_merge_upsert,
    "skip_existing": q_skip_existing,
    "scd2_history": _scd(lambda h: h),
    "scd2_current": _scd(scd2.current_rows),
    "scd2_as_of": _scd(lambda h: scd2.as_of_view(h, SCD_VIEW_AT)),
    "check_single_active_version": _scd(lambda h: scd2.single_active_version(h, "id")),
    **{k: _check(fn) for k, fn in CHECKS.items()},
    **{k: _check(fn) for k, fn in VIOLATED.items()},
    "violated_single_active": q_violated_single_active,
    "violated_volume_anomalies": q_violated_volume,
    "price_by_sentiment_nulls": q_price_by_sentiment_nulls,
    "scd2_snapshot_table": q_scd2_snapshot_table,
    "late_calendar": q_late_calendar,
    "lineage_nations": q_lineage_nations,
    "volume_anomaly_scores": q_volume_scores,
    "volume_anomalies": q_volume_anomalies,
    "dimension_anomaly_scores": q_dimension_scores,
    "dimension_anomalies": q_dimension_anomalies,
    "profile_rows": q_profile_rows,
    "profile_numeric": q_profile_numeric,
    "profile_string": q_profile_string,
    "profile_dates": q_profile_dates,
    "profile_boolean": q_profile_boolean,
    "profile_quality": q_profile_quality,
    "profile_wide": q_profile_wide,
    "profile_big_integers": q_profile_big_integers,
    "profile_incremental": q_profile_incremental,
    "column_modes": q_column_modes,
    "sample_hash": q_sample_hash,
    "sample_bernoulli": q_sample_bernoulli,
    "lineage_impact": q_lineage_impact,
    "lineage_cycles": q_lineage_cycles,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: (lambda fn: (lambda spark, sf: normalise(fn(spark, sf))))(fn)
            for k, fn in QUERIES.items()}
