"""Each check: one passing and one failing input."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeflow.operators import checks as C


def n(df):
    return df.count()


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k bigint")
    assert [tuple(r) for r in C.unique(df, "k").collect()] == [(1, 2)]
    assert n(C.not_null(df, "k")) == 2
    assert n(C.unique(df.filter("k = 2"), "k")) == 0


def test_accepted_values_null_passes(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("z",), ("z",)], "v string")
    assert [tuple(r) for r in C.accepted_values(df, "v", ["a", "b"]).collect()] == [("z", 2)]


def test_relationships_and_positive(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (-3,)], "p bigint")
    parent = spark.createDataFrame([(1,), (2,)], "id bigint")
    assert [r.p for r in C.relationships(child, "p", parent, "id").collect()] == [-3]
    assert [r.p for r in C.positive_value(child, "p").collect()] == [-3]


def test_percentage_boundaries(spark):
    base = [("x",)] * 95 + [(None,)] * 5
    exactly5 = spark.createDataFrame(base, "v string")
    assert n(C.null_percentage(exactly5, "v", 5)) == 0                 # exactly 5 % passes
    over = spark.createDataFrame(base + [(None,)], "v string")
    assert [tuple(r) for r in C.null_percentage(over, "v", 5).collect()] == [(101, 6)]
    empty = spark.createDataFrame([], "v string")
    assert n(C.null_percentage(empty, "v", 5)) == 0                    # empty table passes
    zeros = spark.createDataFrame([(0,)] * 2 + [(1,)] * 8, "m bigint")
    assert n(C.value_percentage(zeros, "m", 0, 5)) == 1


def test_joint_null_needs_all_columns(spark):
    df = spark.createDataFrame([(None, None), (None, "x"), ("y", None)], "a string, b string")
    assert [tuple(r) for r in C.null_percentage(df, ["a", "b"], 5).collect()] == [(3, 1)]


def test_parseable_checks(spark):
    prices = spark.createDataFrame([("$90.00",), ("$-5.00",), ("$1.5d",), ("$NaN",), (None,),
                                    ("$1,200.00",)], "p string")
    assert sorted(str(r.p) for r in C.parseable_positive(prices, "p").collect()) == \
        sorted(["$-5.00", "$1.5d", "$NaN", "None", "$1,200.00"])
    flags = spark.createDataFrame([("t",), ("on",), ("maybe",), (None,), ("",)], "f string")
    assert sorted(r.f for r in C.parseable_boolean(flags, "f").collect()) == ["", "maybe"]


def test_no_nulls_false_is_fine(spark):
    df = spark.createDataFrame([(1, False), (2, None), (None, True)], "a bigint, b boolean")
    assert n(C.no_nulls(df)) == 2


def test_missing_months(spark):
    src = spark.createDataFrame([(dt.datetime(2020, 1, 3),), (dt.datetime(2020, 4, 3),)],
                                "created_at timestamp_ntz")
    series = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2020, 3, 1),),
                                    (dt.date(2020, 4, 1),)], "listing_month date")
    assert [r.listing_month for r in C.missing_months(series, "listing_month", src, "created_at")
            .collect()] == [dt.date(2020, 2, 1)]


def test_created_after_review_and_sample(spark):
    listings = spark.createDataFrame([(1, dt.datetime(2020, 1, 5))], "listing_id bigint, created_at timestamp_ntz")
    reviews = spark.createDataFrame([(1, dt.datetime(2020, 1, 5)), (1, dt.datetime(2020, 1, 6))],
                                    "listing_id bigint, review_date timestamp_ntz")
    assert n(C.created_after_review(listings, reviews)) == 1
    df = spark.range(30).withColumnRenamed("id", "m")
    got = C.sample_failures(df, F.col("m") < 25, 10, ["m"]).collect()
    assert [r.m for r in got] == list(range(10))


def test_between_and_aggregates(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    assert n(C.between(df, "x", 0, 100)) == 0
    assert n(C.between(df, "x", 0, 100, strictly=True)) == 1
    assert n(C.agg_between(df, "x", "max", max_value=5000)) == 0
    assert [r.max_value for r in C.agg_between(df, "x", "max", max_value=50).collect()] == [100.0]
    assert n(C.quantile_between(df, "x", 0.99, 50, 500)) == 0
    assert n(C.quantile_between(df, "x", 0.99, 100, 500)) == 1


def test_freshness_statuses(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 0),)], "ts timestamp_ntz")
    assert n(C.freshness(df, "ts", "2024-01-01 11:00:00")) == 0          # exactly 1 h
    assert C.freshness(df, "ts", "2024-01-01 11:01:00").collect()[0].status == "warn"
    warn = C.freshness(df, "ts", "2024-01-01 12:00:00").collect()
    assert [(r.hours_since_load, r.status) for r in warn] == [(2, "warn")]
    assert C.freshness(df, "ts", "2024-01-02 10:00:00").collect()[0].status == "warn"   # 24 h
    assert C.freshness(df, "ts", "2024-01-02 11:00:00").collect()[0].status == "error"  # 25 h


def test_distinct_and_row_count(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert n(C.distinct_count_equals(df, "v", 2)) == 0
    assert n(C.distinct_count_equals(df, "v", 3)) == 1
    assert n(C.row_count_equals(df, spark.range(3))) == 0
    assert [tuple(r) for r in C.row_count_equals(df, spark.range(5)).collect()] == [(3, 5)]


def test_regex(spark):
    df = spark.createDataFrame([("$9.00",), ("$9",), ("$1,200",), (None,)], "p string")
    assert sorted(r.p for r in C.matches_regex(df, "p", r"^\$[0-9][0-9\.]+$").collect()) == ["$1,200", "$9"]


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, 1.5, "x")], "a bigint, b double, c string")
    assert n(C.of_type(df, "a", "number")) == 0
    assert n(C.of_type(df, "b", "float")) == 0
    assert n(C.of_type(df, "c", "number")) == 1
    declared = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()),
                             T.StructField("d", T.DateType())])
    got = sorted(tuple(r) for r in C.schema_vs_baseline(df, declared).collect())
    assert got == [("column_added", "c", None, "string"), ("column_removed", "d", "date", None),
                   ("type_changed", "b", "string", "double")]


def test_runner(spark, scratch):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k bigint")
    suite = [C.Check("uniq", lambda: C.unique(df, "k")),
             C.Check("nn", lambda: C.not_null(df, "k")),
             C.Check("soft", lambda: C.unique(df, "k"), severity="warn")]
    res = {r.check_name: (r.failures, r.status) for r in
           C.run_checks(spark, suite, f"{scratch}/fail").collect()}
    assert res == {"uniq": (1, "fail"), "nn": (0, "pass"), "soft": (1, "warn")}
    assert spark.read.parquet(f"{scratch}/fail/uniq").count() == 1


def test_schema_snapshots_diff_with_a_join(spark):
    old = spark.createDataFrame([(1, "a", 1.0)], "id bigint, v string, gone double")
    new = spark.createDataFrame([(1, 2, True)], "id bigint, v bigint, added boolean")
    got = sorted(tuple(r) for r in C.schema_changes_since(C.schema_snapshot(old, "t"),
                                                           C.schema_snapshot(new, "t")).collect())
    assert got == [("t", "column_added", "added", None, "boolean"),
                   ("t", "column_removed", "gone", "double", None),
                   ("t", "type_changed", "v", "string", "bigint")]
