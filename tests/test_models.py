"""Model functions: cleansing rules, buckets, calendar join, flagship values."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lodgeflow.plans import models as M
from lodgeflow.plans import registry as R
from lodgeflow.sources.raw import moon_calendar


def test_flagship_matches_published_values(spark):
    rows = R.queries()["price_by_sentiment"](spark, "/root/testdata/sf0.01").collect()
    got = {r.review_sentiment: (r.review_count, r.avg_price, r.price_stddev, r.median_price,
                                r.min_price, r.max_price) for r in rows}
    assert got == {
        "negative": (567, 241.26, 149.82, 239.69, 0.23, 499.51),
        "neutral": (599, 244.78, 144.04, 235.65, 0.47, 498.72),
        "positive": (582, 250.19, 145.02, 253.44, 0.75, 499.39),
    }
    assert [r.review_sentiment for r in rows] == ["positive", "neutral", "negative"]


def test_stddev_of_single_review_is_null(spark):
    mart = spark.createDataFrame([(1, "positive", True)],
                                 "listing_id bigint, review_sentiment string, is_full_moon boolean")
    listings = spark.createDataFrame([(1, Decimal("10.00"))], "listing_id bigint, price decimal(10,2)")
    r = M.price_sentiment_correlation(mart, listings).collect()[0]
    assert r.review_count == 1 and r.price_stddev is None and float(r.median_price) == 10.0


def test_flagship_weighted_stats_equal_row_level_stats(spark):
    # a listing that holds most reviews (the hot key) must weigh correctly
    mart = spark.createDataFrame(
        [(1, "p", True)] * 50 + [(2, "p", True), (3, "p", True), (3, "p", False)],
        "listing_id bigint, review_sentiment string, is_full_moon boolean")
    listings = spark.createDataFrame([(1, Decimal("10.00")), (2, Decimal("20.00")),
                                      (3, Decimal("90.00"))], "listing_id bigint, price decimal(10,2)")
    got = M.price_sentiment_correlation(mart, listings).collect()[0]
    rows = mart.filter("is_full_moon").join(listings, "listing_id")
    exp = rows.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("price").cast("double")).alias("a"),
                   F.stddev(F.col("price").cast("double")).alias("s"),
                   F.percentile("price", 0.5).alias("m")).collect()[0]
    assert got.review_count == exp.n
    assert float(got.avg_price) == round(exp.a, 2)
    assert float(got.price_stddev) == round(exp.s, 2)
    assert float(got.median_price) == round(exp.m, 2)


def test_moon_join_day_after_only(spark):
    cal = spark.createDataFrame([(dt.date(2020, 1, 10),), (dt.date(2020, 1, 10),)], "full_moon_date date")
    rows = [(1, dt.datetime(2020, 1, 10, 12)), (2, dt.datetime(2020, 1, 11, 23, 59)),
            (3, dt.datetime(2020, 1, 12, 0, 0)), (4, None)]
    df = spark.createDataFrame(rows, "id bigint, review_date timestamp_ntz")
    got = {r.id: r.is_full_moon for r in M.flag_day_after(df, "review_date", cal).collect()}
    assert got == {1: False, 2: True, 3: False, 4: False}  # duplicate moon does not double rows


def test_buckets(spark):
    nights = [None, -1, 0, 1, 2, 3, 4, 7, 8, 14, 15, 30, 31]
    prices = [None, "49.99", "50", "150", "150.01"]
    rows = [(n, Decimal(p) if p else None) for n in nights for p in prices[:1]] + \
           [(1, Decimal(p) if p else None) for p in prices]
    df = spark.createDataFrame(rows, "minimum_nights bigint, price decimal(10,2)")
    out = M.listings_distribution(df).collect()
    by_n = {r.minimum_nights: (r.minimum_nights_category, r.stay_duration_type)
            for r in out[:len(nights)]}
    assert by_n[None] == ("30+ nights", "Long-term")
    assert by_n[-1] == ("30+ nights", "Short-term")
    assert by_n[1] == ("1 night", "Short-term")
    assert by_n[3] == ("2-3 nights", "Short-term")
    assert by_n[4] == ("4-7 nights", "Medium-term")
    assert by_n[14] == ("8-14 nights", "Medium-term")
    assert by_n[15] == ("15-30 nights", "Long-term")
    assert by_n[30] == ("15-30 nights", "Long-term")
    assert by_n[31] == ("30+ nights", "Long-term")
    cats = [r.price_category for r in out[len(nights):]]
    assert cats == ["Premium", "Budget", "Mid-range", "Mid-range", "Premium"]


def test_new_listings_series_fills_gaps(spark):
    rows = [(1, dt.datetime(2020, 1, 5)), (1, dt.datetime(2020, 1, 20)), (2, dt.datetime(2020, 1, 7)),
            (3, dt.datetime(2020, 5, 1))]
    df = spark.createDataFrame(rows, "listing_id bigint, created_at timestamp_ntz")
    got = [(r.listing_month, r.new_listings) for r in M.new_listings_time_series(df).collect()]
    assert got == [(dt.date(2020, 1, 1), 2), (dt.date(2020, 2, 1), 0), (dt.date(2020, 3, 1), 0),
                   (dt.date(2020, 4, 1), 0), (dt.date(2020, 5, 1), 1)]


def test_new_listings_single_month(spark):
    df = spark.createDataFrame([(1, dt.datetime(2020, 3, 5))], "listing_id bigint, created_at timestamp_ntz")
    assert [(r.listing_month, r.new_listings) for r in M.new_listings_time_series(df).collect()] == \
        [(dt.date(2020, 3, 1), 1)]


def test_dim_hosts_cleansing(spark):
    src = spark.createDataFrame([(1, None, None), (2, "", "t"), (3, "Ann", "T")],
                                "host_id bigint, host_name string, is_superhost string") \
        .withColumn("created_at", F.lit(None).cast("timestamp_ntz")) \
        .withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    got = [(r.host_name, r.is_superhost) for r in M.dim_hosts_cleansed(src).orderBy("host_id").collect()]
    assert got == [("Anonymous", False), ("", True), ("Ann", False)]


def test_moon_calendar_rule(spark):
    span = spark.createDataFrame([(dt.date(1995, 1, 20),), (None,), (dt.date(1995, 3, 10),)], "d date")
    days = [r[0] for r in moon_calendar(span).orderBy("full_moon_date").collect()]
    assert [d for d in days if dt.date(1995, 1, 1) <= d <= dt.date(1995, 3, 31)] == [
        dt.date(1995, 1, 16), dt.date(1995, 2, 14), dt.date(1995, 3, 16)]
    assert days[0] < dt.date(1995, 1, 1) and days[-1] > dt.date(1995, 3, 31)
    late = moon_calendar(spark.createDataFrame([(dt.date(2150, 6, 1),), (dt.date(1700, 6, 1),)], "d date"))
    years = {r[0].year for r in late.collect()}
    assert years == set(range(1700, 2151))
    assert moon_calendar(span.filter("d IS NULL")).count() == 0


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["review_sentiment", "review_count", "avg_price", "price_stddev",
                          "median_price", "min_price", "max_price"]
    assert df.count() == 3
