"""The marketplace models as DataFrame functions.

Each function takes its upstream DataFrames and returns a lazy DataFrame, so
a chain of models compiles to one Catalyst plan: column pruning and filter
pushdown reach the Parquet scans, and only the final write materialises.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.functions.columns import (decode_flag, default_if_null, flag_match,
                                         greatest_strict, month_start, parse_money,
                                         replace_value, surrogate_key)
from lodgeflow.functions.tiers import tier
from lodgeflow.operators.quantiles import exact_percentiles
from lodgeflow.operators.scd2 import current_rows
from lodgeflow.sources.raw import month_calendar

# Fixed values of the cleansing and bucketing rules (tier tables: first
# matching rule wins, NULL takes the default — see functions.tiers).
ANONYMOUS_HOST = "Anonymous"
NIGHTS_CATEGORY = ((("==", 1, "1 night"), ("between", (2, 3), "2-3 nights"),
                    ("between", (4, 7), "4-7 nights"), ("between", (8, 14), "8-14 nights"),
                    ("between", (15, 30), "15-30 nights")), "30+ nights")
STAY_TYPE = ((("<=", 3, "Short-term"), ("<=", 14, "Medium-term")), "Long-term")
PRICE_CATEGORY = ((("<", 50, "Budget"), ("between", (50, 150), "Mid-range")), "Premium")


# --- staging (P1–P3, S3) ------------------------------------------------------
def src_hosts(scd_hosts: DataFrame) -> DataFrame:
    return current_rows(scd_hosts).select(
        F.col("id").alias("host_id"), F.col("name").alias("host_name"),
        "is_superhost", "created_at", "updated_at")


def src_listings(scd_listings: DataFrame) -> DataFrame:
    return current_rows(scd_listings).select(
        F.col("id").alias("listing_id"), F.col("name").alias("listing_name"),
        "listing_url", "room_type", "minimum_nights", "host_id",
        F.col("price").alias("price_str"), "created_at", "updated_at")


def src_reviews(raw_reviews: DataFrame) -> DataFrame:
    return raw_reviews.select(
        "listing_id", F.col("date").alias("review_date"), "reviewer_name",
        F.col("comments").alias("review_text"),
        F.col("sentiment").alias("review_sentiment"))


# --- dimensions (P4–P7, P10, J1) ----------------------------------------------
def dim_hosts_cleansed(src: DataFrame) -> DataFrame:
    return src.select(
        "host_id",
        default_if_null("host_name", ANONYMOUS_HOST).alias("host_name"),
        decode_flag("is_superhost").alias("is_superhost"),
        "created_at", "updated_at")


def dim_listings_cleansed(src: DataFrame) -> DataFrame:
    return src.select(
        "listing_id", "listing_name", "room_type",
        replace_value("minimum_nights", 0, 1).alias("minimum_nights"),
        "host_id",
        parse_money("price_str").alias("price"),
        "created_at", "updated_at")


def dim_listings_with_hosts(listings: DataFrame, hosts: DataFrame) -> DataFrame:
    """Left join listings to hosts; ``updated_at`` is NULL-strict GREATEST.

    Both sides hold one row per entity; Catalyst/AQE choose broadcast or
    sort-merge from runtime sizes.
    """
    l = listings.alias("l")
    h = hosts.alias("h")
    return l.join(h, F.col("l.host_id") == F.col("h.host_id"), "left").select(
        F.col("l.listing_id"), F.col("l.listing_name"), F.col("l.room_type"),
        F.col("l.minimum_nights"), F.col("l.price"), F.col("l.host_id"),
        F.col("h.host_name"), F.col("h.is_superhost").alias("host_is_superhost"),
        F.col("l.created_at"),
        greatest_strict(F.col("l.updated_at"), F.col("h.updated_at")).alias("updated_at"))


# --- fact and mart (P8, J2) ---------------------------------------------------
def fct_reviews(src: DataFrame) -> DataFrame:
    """Full build of the review fact: reviews with text, plus a surrogate key."""
    return src.filter(F.col("review_text").isNotNull()).select(
        surrogate_key("listing_id", "review_date", "reviewer_name", "review_text")
        .alias("review_id"),
        "listing_id", "review_date", "reviewer_name", "review_text", "review_sentiment")


def flag_day_after(df: DataFrame, ts_col: str, calendar: DataFrame,
                   date_col: str = "full_moon_date", offset_days: int = 1,
                   flag: str = "is_full_moon") -> DataFrame:
    """TRUE when ``to_date(ts_col)`` is ``offset_days`` after a calendar date.

    The calendar is de-duplicated, so a repeated date cannot multiply rows.
    Its join strategy is left to the planner: AQE broadcasts it from its
    measured bytes, so the big side is not shuffled.
    """
    days = calendar.select(F.date_add(F.col(date_col), offset_days).alias("__event_day")).distinct()
    joined = df.join(days, F.to_date(F.col(ts_col)) == F.col("__event_day"), "left")
    return joined.select(*[F.col(c) for c in df.columns],
                         flag_match("__event_day").alias(flag))


def mart_fullmoon_reviews(fct: DataFrame, calendar: DataFrame) -> DataFrame:
    return flag_day_after(fct, "review_date", calendar)


# --- analysis tables ---------------------------------------------------------
def price_sentiment_correlation(mart: DataFrame, listings: DataFrame) -> DataFrame:
    """A2 on full-moon reviews: count, avg, sample stddev, exact median, min, max.

    Plan for scale: reviews are first combined per (listing, sentiment) —
    a partial aggregate, so a listing holding a third of all reviews still
    leaves each map task as a handful of rows — then joined to the listing
    price and reduced per sentiment with count-weighted statistics. The
    median is exact and parallel (``quantiles.exact_percentiles``, weighted
    by the review count): no task holds all prices of a sentiment.
    """
    per_listing = (mart.filter(F.col("is_full_moon"))
                   .groupBy("listing_id", "review_sentiment")
                   .agg(F.count(F.lit(1)).alias("n")))
    priced = per_listing.join(listings.select("listing_id", "price"), "listing_id", "inner")
    p = F.col("price")
    n = F.col("n")
    # Sums of n·p and n·p² are exact decimals; they are combined in double
    # only at the end, so the variance does not suffer from summation order.
    stats = priced.groupBy("review_sentiment").agg(
        F.sum(n).alias("review_count"),
        F.sum(F.when(p.isNotNull(), n)).alias("priced"),    # reviews of listings without a price only count
        F.sum(p * n).cast("double").alias("s1"),
        F.sum(p * p * n).cast("double").alias("s2"),
        F.min(p).alias("min_price"),
        F.max(p).alias("max_price"))
    median = exact_percentiles(priced, "review_sentiment", "price", "n", [0.5], prefix="median")
    cnt = F.col("priced")
    mean = F.col("s1") / cnt
    variance = ((F.col("s2") - F.col("s1") * F.col("s1") / cnt)
                / F.nullif(cnt - 1, F.lit(0)))
    # one row per sentiment on both sides; a NULL sentiment is a group, and a
    # group without any price keeps its row with NULL statistics
    median = median.withColumnRenamed("review_sentiment", "__sentiment")
    same = F.col("review_sentiment").eqNullSafe(F.col("__sentiment"))
    return (stats.join(median, same, "left").select(
                "review_sentiment", "review_count",
                F.round(mean, 2).alias("avg_price"),
                # clamp rounding noise below zero; NULL (one review) stays NULL
                F.round(F.sqrt(F.when(variance < 0, F.lit(0.0)).otherwise(variance)), 2)
                .alias("price_stddev"),
                F.round(F.col("median0"), 2).alias("median_price"),
                "min_price", "max_price")
            .orderBy(F.col("avg_price").desc_nulls_first()))


def review_sentiment_by_month(fct: DataFrame) -> DataFrame:
    """A3: reviews per month-of-year and sentiment (years pooled)."""
    return (fct.groupBy(F.month("review_date").alias("review_month"), "review_sentiment")
            .agg(F.count(F.lit(1)).alias("reviews_count"))
            .orderBy(F.col("review_month").asc_nulls_last(),
                     F.col("review_sentiment").asc_nulls_last()))


def new_listings_time_series(listings: DataFrame) -> DataFrame:
    """S5 + J5 + A4/A5: dense monthly count of distinct new listings.

    Months come from ``sequence(min, max)`` over the one-row bounds, so the
    calendar is exact for any span; the small monthly aggregate is joined to
    it and gaps are zero-filled.
    """
    base = listings.select(month_start("created_at").alias("listing_month"), "listing_id")
    per_month = base.groupBy("listing_month").agg(
        F.count_distinct("listing_id").alias("new_listings"))
    bounds = per_month.agg(F.min("listing_month").alias("min_month"),
                           F.max("listing_month").alias("max_month"))
    months = month_calendar(bounds)
    return (months.join(per_month, "listing_month", "left")
            .select("listing_month", F.coalesce("new_listings", F.lit(0)).alias("new_listings"))
            .orderBy("listing_month"))


def listings_distribution(dlwh: DataFrame) -> DataFrame:
    """Bucket minimum nights, stay length and price."""
    return dlwh.select(
        "*",
        tier(F.col("minimum_nights"), *NIGHTS_CATEGORY).alias("minimum_nights_category"),
        tier(F.col("minimum_nights"), *STAY_TYPE).alias("stay_duration_type"),
        tier(F.col("price"), *PRICE_CATEGORY).alias("price_category"))


def fullmoon_sentiment(mart: DataFrame) -> DataFrame:
    """A1: reviews by (is_full_moon, sentiment)."""
    return (mart.groupBy("is_full_moon", "review_sentiment")
            .agg(F.count(F.lit(1)).alias("reviews"))
            .orderBy(F.col("is_full_moon").asc_nulls_last(),
                     F.col("review_sentiment").asc_nulls_last()))


def _with_share(counts: DataFrame, count_col: str) -> DataFrame:
    # ``counts`` is an aggregate over a bounded set of labels, so the
    # unpartitioned window sees a handful of rows, never the table.
    total = F.sum(count_col).over(Window.partitionBy())
    return counts.withColumn("share_pct", F.round(F.col(count_col) * 100.0 / total, 2))


def superhost_ratio(dlwh: DataFrame) -> DataFrame:
    """Listings per superhost flag and their share."""
    counts = dlwh.groupBy("host_is_superhost").agg(F.count(F.lit(1)).alias("listings"))
    return _with_share(counts, "listings")


def price_histogram(dist: DataFrame) -> DataFrame:
    """Listings per price category and stay-length category."""
    counts = (dist.groupBy("price_category", "minimum_nights_category")
              .agg(F.count(F.lit(1)).alias("listings"),
                   F.round(F.avg(F.col("price").cast("double")), 2).alias("avg_price")))
    return counts


# --- the whole graph -------------------------------------------------------------
class Models(dict):
    """Model name → DataFrame, each built on first access.

    Building a model is cheap (lazy DataFrames) except where an operator
    proves a size before broadcasting, so models nobody asks for are never
    built at all.
    """

    def __init__(self, builders: dict[str, Callable[["Models"], DataFrame]]):
        super().__init__()
        self._builders = builders

    def __missing__(self, name: str) -> DataFrame:
        if name not in self._builders:
            raise KeyError(name)
        df = self._builders[name](self)
        self[name] = df
        return df

    def __contains__(self, name) -> bool:
        return name in self._builders

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def keys(self):
        return self._builders.keys()

    def items(self):
        return [(k, self[k]) for k in self._builders]

    def values(self):
        return [self[k] for k in self._builders]

    def names(self) -> list[str]:
        return list(self._builders)


def build_models(raw: dict[str, DataFrame], scd_hosts: DataFrame | None = None,
                 scd_listings: DataFrame | None = None) -> Models:
    """Wire every model from the raw inputs (first snapshot when no history)."""
    from lodgeflow.operators.scd2 import scd2_init

    return Models({
        "scd_raw_hosts": lambda m: scd_hosts if scd_hosts is not None
        else scd2_init(raw["hosts"], "id"),
        "scd_raw_listings": lambda m: scd_listings if scd_listings is not None
        else scd2_init(raw["listings"], "id"),
        "dim_hosts_cleansed": lambda m: dim_hosts_cleansed(src_hosts(m["scd_raw_hosts"])),
        "dim_listings_cleansed": lambda m: dim_listings_cleansed(src_listings(m["scd_raw_listings"])),
        "dim_listings_with_hosts": lambda m: dim_listings_with_hosts(
            m["dim_listings_cleansed"], m["dim_hosts_cleansed"]),
        "fct_reviews": lambda m: fct_reviews(src_reviews(raw["reviews"])),
        "mart_fullmoon_reviews": lambda m: mart_fullmoon_reviews(m["fct_reviews"], raw["calendar"]),
        "price_sentiment_correlation": lambda m: price_sentiment_correlation(
            m["mart_fullmoon_reviews"], m["dim_listings_cleansed"]),
        "review_sentiment_by_month": lambda m: review_sentiment_by_month(m["fct_reviews"]),
        "new_listings_time_series": lambda m: new_listings_time_series(m["dim_listings_cleansed"]),
        "dim_listings_with_hosts_distribution_analysis": lambda m: listings_distribution(
            m["dim_listings_with_hosts"]),
    })
