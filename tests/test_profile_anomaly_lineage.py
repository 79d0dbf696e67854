"""Profiler, anomaly detection and lineage impact on hand-written inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodgeflow.operators import anomaly as A
from lodgeflow.operators import lineage as G
from lodgeflow.operators import profile as P


# --- profiler --------------------------------------------------------------------------
def test_column_profile_edge_values(spark):
    rows = [("12\n", None, "a", 1.0, True), ("   ", None, "a", 2.0, False),
            ("", None, "a", 3.0, None), ("Ab c", None, "a", None, True)]
    df = spark.createDataFrame(rows, "s string, allnull string, const string, x double, b boolean")
    p = {r.column_name: r for r in P.column_profile(df).collect()}
    s = p["s"]
    assert (s.empty_count, s.whitespace_only_count, s.numeric_pattern_count,
            s.alpha_pattern_count) == (1, 1, 0, 2)            # '12\n' is not numeric; '   ' is alpha
    assert p["allnull"].null_count == 4 and p["allnull"].distinct_count == 0
    assert p["allnull"].cardinality_category == "LOW_CARDINALITY"
    assert p["const"].cardinality_category == "CONSTANT" and p["const"].mode == "a"
    assert p["x"].cardinality_category == "LOW_CARDINALITY"
    assert p["x"].min == 1.0 and p["x"].max == 3.0 and p["x"].median == 2.0
    assert p["x"].completeness_rate == 75.0 and p["x"].uniqueness_rate == 75.0


def test_cardinality_thresholds_and_unique(spark):
    df = spark.createDataFrame([(i, i % 10, i % 11, i % 100, i % 101) for i in range(202)],
                               "u bigint, c10 bigint, c11 bigint, c100 bigint, c101 bigint")
    p = {r.column_name: r.cardinality_category for r in P.column_profile(df).collect()}
    assert p == {"u": "UNIQUE", "c10": "LOW_CARDINALITY", "c11": "MEDIUM_CARDINALITY",
                 "c100": "MEDIUM_CARDINALITY", "c101": "HIGH_CARDINALITY"}
    one = spark.createDataFrame([(5,)], "v bigint")
    assert P.column_profile(one).collect()[0].cardinality_category == "UNIQUE"


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "s string")
    assert P.column_profile(df).collect()[0].mode == "a"


def test_numeric_moments_match_spark_aggregates(spark):
    vals = [float(v) for v in [1, 2, 2, 3, 3, 3, 50, 7, 8, 9, 10, 11, 12]]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = P.column_profile(df).collect()[0]
    e = df.agg(F.avg("x"), F.stddev("x"), F.variance("x"),
               F.percentile("x", [0.25, 0.5, 0.75])).collect()[0]
    assert r.avg == pytest.approx(e[0]) and r.stddev == pytest.approx(e[1])
    assert r.variance == pytest.approx(e[2]) and [r.p25, r.median, r.p75] == pytest.approx(e[3])
    mean, sd = e[0], e[1]
    assert r.outlier_count == sum(1 for v in vals if abs(v - mean) > 3 * sd)


def test_whole_row_distinct_matches_reference_semantics(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "x"), ("NULL", "x")], "a string, b string")
    m = P.table_metrics(df).collect()[0]
    assert (m.total_rows, m.distinct_rows, m.duplicate_rate) == (4, 2, 50.0)


def test_empty_table_profile(spark):
    df = spark.createDataFrame([], "x double, s string")
    m = P.table_metrics(df).collect()[0]
    assert m.total_rows == 0 and m.duplicate_rate is None


def test_profile_table_wide_row_and_history(spark):
    df = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1, 10), True),
                                (2, "b", dt.datetime(2024, 1, 2, 10), False)],
                               "id bigint, s string, ts timestamp_ntz, f boolean")
    w = P.profile_table(df, "m", date_col="ts", as_of="2024-01-03 10:30:00", env="dev")
    r = w.collect()[0]
    assert r.profile_run_id == "dev_m_2024010300"
    assert (r.total_rows, r.distinct_rows, r.total_columns) == (2, 2, 4)
    assert (r.hours_since_update, r.freshness_status) == (24, "FRESH")
    assert (r.f_true_count, r.f_false_count) == (1, 1)
    assert r.ts_date_range_days == 1 and r.ts_distinct_dates == 2
    assert r.id_cardinality_category == "UNIQUE" and r.profile_hash is not None
    hist = P.merge_profile_history(None, w)
    again = P.merge_profile_history(hist, w)                       # same run id: skipped
    assert again.count() == 1
    stale = P.profile_table(df, "m", date_col="ts", as_of="2024-01-03 11:00:00")
    assert stale.collect()[0].freshness_status == "STALE"          # 25 h


def test_exclusion_is_case_insensitive(spark):
    df = spark.createDataFrame([(1, "a")], "ID bigint, s string")
    assert [c for c, _ in P.column_families(df, ["id"])] == ["s"]


def test_hash_sample_is_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = P.sample_rows(df, 50, method="hash", key="k")
    b = P.sample_rows(df, 50, method="hash", key="k")
    assert 800 < a.count() < 1200 and a.exceptAll(b).count() == 0


# --- anomalies ----------------------------------------------------------------------------
def series_df(spark, counts, start=dt.date(2024, 1, 1), dim=None):
    rows = []
    for i, c in enumerate(counts):
        day = dt.datetime.combine(start + dt.timedelta(days=i), dt.time(12))
        rows += [(day, dim)] * c
    return rows


def test_flat_series_spike_and_drop(spark):
    flat = [10] * 14
    df = spark.createDataFrame(series_df(spark, flat + [20]), "ts timestamp_ntz, d string")
    s = A.anomaly_scores(df, "ts").collect()
    assert [r.anomaly for r in s][-1] == "spike" and s[-1].training_stddev == 0
    drop = spark.createDataFrame(series_df(spark, flat + [5]), "ts timestamp_ntz, d string")
    assert A.anomaly_scores(drop, "ts").collect()[-1].anomaly == "drop"
    small = spark.createDataFrame(series_df(spark, flat + [11]), "ts timestamp_ntz, d string")
    assert A.anomaly_scores(small, "ts").collect()[-1].anomaly is None  # +10 % is not > 10 %


def test_missing_day_is_zero_and_short_history_not_scored(spark):
    counts = [10, 10, 0, 10, 10]
    df = spark.createDataFrame(series_df(spark, counts), "ts timestamp_ntz, d string")
    assert A.anomaly_scores(df, "ts").count() == 0                     # fewer than 7 buckets
    s = A.zero_fill(A.bucket_counts(df, "ts"))
    assert sorted(r.row_count for r in s.collect()) == [0, 10, 10, 10, 10]


def test_detection_delay_drops_recent_days(spark):
    df = spark.createDataFrame(series_df(spark, [10] * 14 + [40]), "ts timestamp_ntz, d string")
    got = A.volume_anomalies(df, "ts", as_of="2024-01-16 00:00:00", detection_delay_days=1)
    assert got.count() == 0                                           # spike day is inside the delay
    got = A.volume_anomalies(df, "ts", as_of="2024-01-17 00:00:00", detection_delay_days=1)
    assert got.count() == 1


def test_dimension_series_per_value(spark):
    rows = series_df(spark, [5] * 14 + [5], dim="a") + series_df(spark, [5] * 14 + [50], dim="b")
    df = spark.createDataFrame(rows, "ts timestamp_ntz, d string")
    got = A.dimension_anomalies(df, "ts", ["d"]).collect()
    assert [(r.d, r.anomaly) for r in got] == [("b", "spike")]


# --- lineage ---------------------------------------------------------------------------------
REFERENCE_EDGES = [
    ("src_hosts", "dim_hosts_cleansed"), ("src_listings", "dim_listings_cleansed"),
    ("dim_listings_cleansed", "dim_listings_with_hosts"), ("dim_hosts_cleansed", "dim_listings_with_hosts"),
    ("src_reviews", "fct_reviews"), ("fct_reviews", "mart_fullmoon_reviews"),
    ("mart_fullmoon_reviews", "price_sentiment_correlation"),
    ("dim_listings_cleansed", "price_sentiment_correlation"),
    ("fct_reviews", "review_sentiment_by_month"), ("dim_listings_cleansed", "new_listings_time_series"),
    ("dim_listings_with_hosts", "dim_listings_with_hosts_distribution_analysis"),
    ("dim_listings_with_hosts", "profile_dim_listings_with_hosts"),
    ("dim_listings_with_hosts_distribution_analysis", "model_lineage"),
]


def test_reference_graph_matches_fixture(spark):
    edges = spark.createDataFrame(REFERENCE_EDGES, "parent string, child string")
    rep = {r.model_name: r for r in G.impact(edges, with_lists=True).collect()}
    expected = {  # FIXTURES.md §5
        "src_listings": (1, 5, 3, "high_impact", "HIGH", 9, "Moderate Business Value", "Low Fanout", "Deep Chain"),
        "src_reviews": (1, 4, 3, "high_impact", "HIGH", 9, "Moderate Business Value", "Low Fanout", "Deep Chain"),
        "dim_listings_cleansed": (3, 4, 2, "high_impact", "HIGH", 8, "Moderate Business Value", "Medium Fanout", "Medium Chain"),
        "src_hosts": (1, 3, 3, "medium_impact", "MEDIUM", 7, "Supporting Role", "Low Fanout", "Deep Chain"),
        "fct_reviews": (2, 3, 2, "medium_impact", "MEDIUM", 6, "Supporting Role", "Medium Fanout", "Medium Chain"),
        "dim_hosts_cleansed": (1, 2, 2, "medium_impact", "MEDIUM", 6, "Supporting Role", "Low Fanout", "Medium Chain"),
        "mart_fullmoon_reviews": (1, 1, 1, "low_impact", "LOW", 3, "Limited Scope", "Low Fanout", "Shallow Chain"),
        "dim_listings_with_hosts": (1, 1, 1, "low_impact", "LOW", 3, "Limited Scope", "Low Fanout", "Shallow Chain"),
        "price_sentiment_correlation": (0, 0, 0, "leaf", "NONE", 0, "End Consumer", "No Fanout", "No Chain"),
        "review_sentiment_by_month": (0, 0, 0, "leaf", "NONE", 0, "End Consumer", "No Fanout", "No Chain"),
        "new_listings_time_series": (0, 0, 0, "leaf", "NONE", 0, "End Consumer", "No Fanout", "No Chain"),
        "dim_listings_with_hosts_distribution_analysis": (0, 0, 0, "leaf", "NONE", 0, "End Consumer", "No Fanout", "No Chain"),
    }
    assert set(rep) == set(expected)                                   # excluded names are gone
    for name, exp in expected.items():
        r = rep[name]
        assert (r.direct_downstream_count, r.total_downstream_count, r.max_downstream_depth,
                r.model_criticality, r.downstream_impact_level, r.change_risk_score,
                r.business_impact_category, r.fanout_pattern, r.chain_pattern) == exp, name
    assert rep["dim_hosts_cleansed"].all_downstream_models == \
        "dim_listings_with_hosts, dim_listings_with_hosts_distribution_analysis"


def test_cycle_diamond_isolated_and_deep_chain(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(101)]               # deeper than 100
    edges = chain + [("a", "b"), ("b", "a"),                             # cycle
                     ("d", "e"), ("d", "f"), ("e", "g"), ("f", "g")]     # diamond
    e = spark.createDataFrame(edges, "parent string, child string")
    nodes = spark.createDataFrame([(x,) for x in ["iso"]], "name string") \
        .unionByName(e.select(F.col("parent").alias("name"))) \
        .unionByName(e.select(F.col("child").alias("name")))
    rep = {r.model_name: r for r in G.impact(e, nodes).collect()}
    assert rep["n0"].total_downstream_count == 101 and rep["n0"].max_downstream_depth == 101
    assert rep["a"].total_downstream_count == 2                          # b and a itself
    assert rep["d"].total_downstream_count == 3 and rep["d"].max_downstream_depth == 2
    assert rep["iso"].total_downstream_count == 0 and rep["iso"].model_criticality == "leaf"


def test_excluded_middle_node_breaks_the_path(spark):
    e = spark.createDataFrame([("a", "profile_x"), ("profile_x", "c"), ("a", "b")],
                              "parent string, child string")
    rep = {r.model_name: r for r in G.impact(e).collect()}
    assert "profile_x" not in rep and rep["a"].total_downstream_count == 1


def test_distinct_rows_strict_and_reference(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("a", "bc")], "a string, b string")
    assert tuple(P.distinct_rows(df).collect()[0]) == (3, 1)
    assert tuple(P.distinct_rows(df, strict=True).collect()[0]) == (3, 2)


def test_hourly_buckets(spark):
    rows = []
    for h in range(30):
        n = 20 if h == 25 else 4
        rows += [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h, minutes=5), None)] * n
    df = spark.createDataFrame(rows, "ts timestamp_ntz, d string")
    got = A.anomaly_scores(df, "ts", period="hour").collect()
    assert len(got) == 30 - 7
    assert [r.bucket for r in got if r.anomaly] == [dt.datetime(2024, 1, 2, 1)]
    weekly = A.zero_fill(A.bucket_counts(df, "ts", period="week"), period="week").collect()
    assert [r.row_count for r in weekly] == [len(rows)]
