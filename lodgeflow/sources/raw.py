"""Declared raw sources (S1), the event calendar seed (S2) and calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# S1 — declared schemas of the three raw tables.
RAW_HOSTS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("is_superhost", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

RAW_LISTINGS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("listing_url", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("room_type", T.StringType()),
    T.StructField("minimum_nights", T.LongType()),
    T.StructField("host_id", T.LongType()),
    T.StructField("price", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

RAW_REVIEWS_SCHEMA = T.StructType([
    T.StructField("listing_id", T.LongType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("reviewer_name", T.StringType()),
    T.StructField("comments", T.StringType()),
    T.StructField("sentiment", T.StringType()),
])

DECLARED = {
    "hosts": RAW_HOSTS_SCHEMA,
    "listings": RAW_LISTINGS_SCHEMA,
    "reviews": RAW_REVIEWS_SCHEMA,
}

CALENDAR_SCHEMA = T.StructType([T.StructField("full_moon_date", T.DateType())])

# Mean synodic month in days; drives the rule-generated full-moon calendar.
SYNODIC_MONTH_DAYS = 29.530588853


def read_source(spark: SparkSession, name: str, path: str,
                fmt: str = "parquet") -> DataFrame:
    """Scan a raw table with its declared schema (no inference)."""
    return spark.read.schema(DECLARED[name]).format(fmt).load(path)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """A one-column CSV of event dates with a header row."""
    return spark.read.schema(CALENDAR_SCHEMA).option("header", True).csv(path)


def moon_calendar(days: DataFrame, first: str = "1995-01-16") -> DataFrame:
    """Full-moon dates from a rule: ``first + floor(k * synodic month)``, for
    every k (also negative) whose date can matter to the dates in the one column
    of ``days``. The span comes from the data, so no date lies outside it."""
    day = F.col(days.columns[0])
    moons = lambda d: F.floor(F.datediff(d, F.lit(first).cast("date")) / F.lit(SYNODIC_MONTH_DAYS))
    span = days.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).filter("lo IS NOT NULL")
    k = span.select(F.explode(F.sequence(moons(F.col("lo")) - 2, moons(F.col("hi")) + 2)).alias("k"))
    return k.select(F.date_add(F.lit(first).cast("date"),
                               F.floor(F.lit(SYNODIC_MONTH_DAYS) * F.col("k")).cast("int")).alias("full_moon_date"))


def month_calendar(bounds: DataFrame, lo: str = "min_month",
                   hi: str = "max_month", out: str = "listing_month") -> DataFrame:
    """Every month start from ``lo`` to ``hi`` inclusive, no cap.

    ``bounds`` is a one-row DataFrame (an aggregate); ``sequence`` expands it
    to exactly the months needed, so there is no fixed-size generator.
    """
    return bounds.select(
        F.explode(F.sequence(F.col(lo), F.col(hi),
                             F.expr("INTERVAL 1 MONTH"))).alias(out))

