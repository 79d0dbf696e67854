"""The whole check suite of the marketplace: every declared test of its models,
sources and snapshots, with its severity (Q1–Q27).

``m`` maps model names to DataFrames (the stored tables, when they exist), ``raw`` the
sources, ``snapshots`` the history tables. Row-level checks carry their predicate, so
the runner counts all of a table in one scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.functions.columns import any_null, full_match, try_parse_boolean, try_parse_double
from lodgeflow.operators import anomaly
from lodgeflow.operators import checks as C
from lodgeflow.operators.scd2 import single_active_version
from lodgeflow.sources.raw import DECLARED

# Accepted values and patterns of the declared tests.
ROOM_TYPES = ["Entire home/apt", "Private room", "Shared room", "Hotel room"]
SENTIMENTS = ["positive", "neutral", "negative"]
PRICE_REGEX = r"^\$[0-9][0-9\.]+$"

# Which columns the declared tests name.
NOT_NULL = {
    "dim_hosts_cleansed": ["host_id", "host_name", "is_superhost"],
    "dim_listings_cleansed": ["listing_id", "host_id"],
    "fct_reviews": ["review_id"],
    "mart_fullmoon_reviews": ["is_full_moon"],
    "review_sentiment_by_month": ["review_month", "review_sentiment", "reviews_count"],
    "price_sentiment_correlation": ["avg_price", "price_stddev", "median_price"],
    "new_listings_time_series": ["listing_month", "new_listings"],
    "dim_listings_with_hosts_distribution_analysis": ["minimum_nights_category", "stay_duration_type",
                                                      "price_category"],
    "raw_hosts": ["id"],
    "raw_listings": ["id", "listing_url", "name", "host_id"],
    "raw_reviews": ["listing_id", "date", "reviewer_name"],
    "scd_raw_hosts": ["id", "scd_id"],
    "scd_raw_listings": ["id", "scd_id"],
}
UNIQUE = {
    "dim_hosts_cleansed": ["host_id"], "dim_listings_cleansed": ["listing_id"], "fct_reviews": ["review_id"],
    "new_listings_time_series": ["listing_month"], "raw_hosts": ["id"], "raw_listings": ["id"],
    "scd_raw_hosts": ["scd_id"], "scd_raw_listings": ["scd_id"],
}
OF_TYPE = {
    "dim_listings_with_hosts": {"price": "number"},
    "review_sentiment_by_month": {"reviews_count": "number"},
    "price_sentiment_correlation": {"avg_price": "number", "price_stddev": "float", "median_price": "number"},
    "new_listings_time_series": {"listing_month": "date", "new_listings": "number"},
    "dim_listings_with_hosts_distribution_analysis": {"minimum_nights_category": "varchar",
                                                      "stay_duration_type": "varchar", "price_category": "varchar"},
    "raw_hosts": {"id": "number"},
    "raw_listings": {"id": "number", "minimum_nights": "number", "host_id": "number"},
    "raw_reviews": {"listing_id": "number", "date": "timestamp_ntz"},
}
NOT_NEGATIVE = {"price_sentiment_correlation": ["avg_price", "price_stddev", "median_price"],
                "new_listings_time_series": ["new_listings"]}
VOLUME = {"dim_hosts_cleansed": "created_at", "dim_listings_with_hosts": "created_at", "fct_reviews": "review_date"}
DIMENSIONS = [("dim_listings_with_hosts", "created_at", "room_type", 5),
              ("dim_listings_with_hosts", "created_at", "host_is_superhost", 5),
              ("fct_reviews", "review_date", "review_sentiment", 3)]
DISTINCT = [("raw_hosts", "is_superhost", 2), ("raw_listings", "room_type", 4), ("raw_reviews", "sentiment", 3),
            ("dim_listings_with_hosts_distribution_analysis", "stay_duration_type", 3),
            ("dim_listings_with_hosts_distribution_analysis", "price_category", 3)]


def _price(c: str):
    return try_parse_double(F.replace(F.col(c), F.lit("$")))


def full_suite(raw: dict[str, DataFrame], m, snapshots: dict[str, DataFrame] | None = None,
               as_of=None, previous_schemas: DataFrame | None = None) -> list[C.Check]:
    """All checks whose table is at hand. ``previous_schemas`` (rows of
    ``checks.schema_snapshot``) adds the schema-change checks."""
    frames = {"raw_hosts": raw["hosts"], "raw_listings": raw["listings"], "raw_reviews": raw["reviews"],
              **(snapshots or {})}
    of = lambda t: frames[t] if t in frames else m[t]
    has = lambda t: t in frames or t in m
    out: list[C.Check] = []

    def rows(name: str, table: str, failing, severity: str = "error") -> None:
        if has(table):
            out.append(C.Check(name, build=lambda: of(table).filter(failing), severity=severity, model=table,
                               failing=failing, frame=lambda: of(table)))

    def frame(name: str, table: str, build, severity: str = "error") -> None:
        if has(table):
            out.append(C.Check(name, build=build, severity=severity, model=table))

    for t, columns in NOT_NULL.items():
        for c in columns:
            rows(f"not_null_{t}_{c}", t, F.col(c).isNull())
    for t, columns in UNIQUE.items():
        for c in columns:
            frame(f"unique_{t}_{c}", t, lambda t=t, c=c: C.unique(of(t), c))
    for t, columns in OF_TYPE.items():
        for c, family in columns.items():
            frame(f"of_type_{t}_{c}", t, lambda t=t, c=c, f=family: C.of_type(of(t), c, f))
    for t, columns in NOT_NEGATIVE.items():
        for c in columns:
            rows(f"between_{t}_{c}", t, F.coalesce(F.col(c) < 0, F.lit(False)))
    for t, c, n in DISTINCT:
        frame(f"distinct_count_{t}_{c}", t, lambda t=t, c=c, n=n: C.distinct_count_equals(of(t), c, n))
    accepted = lambda c, values: F.coalesce(~F.col(c).isin(*values), F.lit(False))
    below_one = lambda c: F.coalesce(F.col(c) < 1, F.lit(False))
    rows("accepted_values_dim_hosts_is_superhost", "dim_hosts_cleansed", accepted("is_superhost", [True, False]))
    rows("accepted_values_dim_listings_room_type", "dim_listings_cleansed", accepted("room_type", ROOM_TYPES))
    rows("accepted_values_mart_is_full_moon", "mart_fullmoon_reviews", accepted("is_full_moon", [True, False]))
    rows("accepted_values_review_sentiment_by_month", "review_sentiment_by_month",
         accepted("review_sentiment", SENTIMENTS))
    rows("accepted_values_raw_reviews_sentiment", "raw_reviews", accepted("sentiment", SENTIMENTS))
    rows("positive_value_dim_listings_minimum_nights", "dim_listings_cleansed", below_one("minimum_nights"))
    rows("positive_value_review_sentiment_by_month", "review_sentiment_by_month", below_one("reviews_count"))
    rows("positive_value_raw_listings_host_id", "raw_listings", below_one("host_id"))
    rows("regex_raw_listings_price", "raw_listings",
         F.col("price").isNotNull() & ~full_match("price", PRICE_REGEX))
    rows("price_parses_raw_listings", "raw_listings", _price("price").isNull() | (_price("price") < 0))
    rows("boolean_parses_raw_hosts", "raw_hosts",
         try_parse_boolean("is_superhost").isNull() & F.col("is_superhost").isNotNull())
    for t in ("dim_hosts_cleansed", "dim_listings_cleansed"):
        if has(t):
            rows(f"no_nulls_in_{t}", t, any_null(of(t).columns))
    frame("dim_listings_minimum_nights", "dim_listings_cleansed", lambda: C.sample_failures(
        of("dim_listings_cleansed"), F.col("minimum_nights") < 1, 10, ["listing_id"]))
    frame("consistent_created_at", "dim_listings_cleansed", lambda: C.created_after_review(
        of("dim_listings_cleansed"), of("fct_reviews")))
    frame("relationships_dim_listings_host_id", "dim_listings_cleansed", lambda: C.relationships(
        of("dim_listings_cleansed"), "host_id", of("dim_hosts_cleansed"), "host_id"))
    frame("source_listings_host_exists", "raw_listings", lambda: C.relationships(
        raw["listings"], "host_id", raw["hosts"], "id"))
    frame("source_reviews_listing_exists", "raw_reviews", lambda: C.relationships(
        raw["reviews"], "listing_id", raw["listings"], "id"))
    frame("row_count_dim_listings_with_hosts", "dim_listings_with_hosts", lambda: C.row_count_equals(
        of("dim_listings_with_hosts"), raw["listings"]))
    frame("p99_price", "dim_listings_with_hosts", lambda: C.quantile_between(
        of("dim_listings_with_hosts"), "price", 0.99, 50, 500))
    frame("max_price", "dim_listings_with_hosts", lambda: C.agg_between(
        of("dim_listings_with_hosts"), "price", "max", max_value=5000), "warn")
    frame("min_minimum_nights_raw_listings", "raw_listings", lambda: C.agg_between(
        raw["listings"], "minimum_nights", "min", min_value=0))
    frame("zero_pct_minimum_nights", "raw_listings", lambda: C.value_percentage(
        raw["listings"], "minimum_nights", 0, 5), "warn")
    frame("source_hosts_name_null_pct", "raw_hosts", lambda: C.null_percentage(raw["hosts"], "name", 5), "warn")
    frame("source_hosts_is_superhost_null_pct", "raw_hosts", lambda: C.null_percentage(
        raw["hosts"], "is_superhost", 5), "warn")
    frame("null_comment_and_sentiment_pct", "fct_reviews", lambda: C.null_percentage(
        of("fct_reviews"), ["review_text", "review_sentiment"], 5), "warn")
    frame("missing_months", "new_listings_time_series", lambda: C.missing_months(
        of("new_listings_time_series"), "listing_month", of("dim_listings_cleansed"), "created_at"))
    frame("freshness_raw_reviews", "raw_reviews", lambda: C.freshness(raw["reviews"], "date", as_of, 1, 24), "warn")
    for t, ts in VOLUME.items():
        frame(f"volume_anomalies_{t}", t, lambda t=t, ts=ts: anomaly.volume_anomalies(
            of(t), ts, as_of=as_of, detection_delay_days=1, spike_pct=10, drop_pct=5), "warn")
    for t, ts, c, pct in DIMENSIONS:
        frame(f"dimension_anomalies_{t}_{c}", t, lambda t=t, ts=ts, c=c, p=pct: anomaly.dimension_anomalies(
            of(t), ts, [c], spike_pct=p, drop_pct=p), "warn")
    for source in ("hosts", "listings", "reviews"):
        frame(f"schema_vs_baseline_raw_{source}", f"raw_{source}", lambda s=source: C.schema_vs_baseline(
            raw[s], DECLARED[s]))
    for t in ("scd_raw_hosts", "scd_raw_listings"):
        frame(f"single_active_version_{t}", t, lambda t=t: single_active_version(of(t), "id"))
    if previous_schemas is not None:
        for t in SCHEMA_TRACKED:
            frame(f"schema_changes_{t}", t, lambda t=t: C.schema_changes_since(
                previous_schemas.filter(F.col("table_name") == t), C.schema_snapshot(of(t), t)),
                "warn" if t in SCHEMA_WARN else "error")
    return out


# Models whose schema changes are tracked; the first four only warn.
SCHEMA_WARN = ["dim_hosts_cleansed", "dim_listings_cleansed", "dim_listings_with_hosts", "fct_reviews"]
SCHEMA_TRACKED = SCHEMA_WARN + ["mart_fullmoon_reviews", "review_sentiment_by_month", "price_sentiment_correlation",
                                "new_listings_time_series", "dim_listings_with_hosts_distribution_analysis"]
