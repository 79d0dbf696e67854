"""Column functions on the hand-written edge rows of FIXTURES §4."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodgeflow.functions import columns as C


def one_col(spark, values, ddl):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_parse_money_rounds_half_up_and_strips_symbol(spark):
    df = one_col(spark, ["$90.00", "$12.345", "$9", None, "$-5.00"], "p string")
    got = [r[0] for r in df.select(C.parse_money("p")).collect()]
    assert got == [Decimal("90.00"), Decimal("12.35"), Decimal("9.00"), None, Decimal("-5.00")]


@pytest.mark.parametrize("bad", ["$1,200.00", "$123456789.00", "$1.5d"])
def test_parse_money_raises_like_a_hard_cast(spark, bad):
    df = one_col(spark, [bad], "p string")
    with pytest.raises(Exception):
        df.select(C.parse_money("p")).collect()


def test_decode_flag_null_is_false(spark):
    df = one_col(spark, ["t", "T", "f", "on", None, ""], "f string")
    assert [r[0] for r in df.select(C.decode_flag("f")).collect()] == \
        [True, False, False, False, False, False]


def test_try_parse_boolean_spellings(spark):
    vals = ["t", "T", "f", "on", "off", "yes", "maybe", None, "", " No "]
    df = one_col(spark, vals, "f string")
    assert [r[0] for r in df.select(C.try_parse_boolean("f")).collect()] == \
        [True, True, False, True, False, True, None, None, None, False]


def test_try_parse_double_rejects_java_suffixes(spark):
    df = one_col(spark, ["1.5", "1.5d", "NaN", "Infinity", "-2", " 3 ", "1e3", "abc"], "s string")
    assert [r[0] for r in df.select(C.try_parse_double("s")).collect()] == \
        [1.5, None, None, None, -2.0, 3.0, 1000.0, None]


def test_replace_value_only_zero(spark):
    df = one_col(spark, [None, -1, 0, 1, 2], "n bigint")
    assert [r[0] for r in df.select(C.replace_value("n", 0, 1)).collect()] == [None, -1, 1, 1, 2]


def test_greatest_strict_propagates_null(spark):
    a, b = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)
    df = spark.createDataFrame([(a, b), (None, b), (a, None), (None, None)],
                               "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(C.greatest_strict("a", "b")).collect()] == [b, None, None, None]


def test_full_match_rejects_trailing_newline(spark):
    df = one_col(spark, ["12", "12\n", "a12", None], "s string")
    got = [r[0] for r in df.select(C.full_match("s", "^[0-9]+$")).collect()]
    assert got == [True, False, False, None]


def test_full_match_keeps_escaped_dollar(spark):
    df = one_col(spark, ["$9.00", "$9", "$1,200"], "s string")
    got = [r[0] for r in df.select(C.full_match("s", r"^\$[0-9][0-9\.]+$")).collect()]
    assert got == [True, False, False]


def test_hour_diff_counts_boundaries(spark):
    rows = [(dt.datetime(2024, 1, 1, 10, 59), dt.datetime(2024, 1, 1, 11, 0)),
            (dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 10, 59)),
            (dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 2, 0, 0))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(C.hour_diff("a", "b")).collect()] == [1, 0, 24]


def test_surrogate_key_null_token_and_stability(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x")], "a bigint, b string")
    keys = [r[0] for r in df.select(C.surrogate_key("a", "b")).collect()]
    assert keys[0] == keys[1] != keys[2]
    assert all(len(k) == 32 for k in keys)


def test_row_text_has_no_separator(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "x"), ("NULL", "x")],
                               "a string, b string")
    got = [r[0] for r in df.select(C.row_text(["a", "b"])).collect()]
    assert got[0] == got[1] and got[2] == got[3]


def test_truncate_period_week_starts_monday(spark):
    df = one_col(spark, [dt.datetime(2024, 1, 4, 15, 30)], "t timestamp_ntz")  # a Thursday
    got = df.select(C.truncate_period("t", "weekly"), C.truncate_period("t", "monthly"),
                    C.truncate_period("t", "hourly")).collect()[0]
    assert got[0] == dt.datetime(2024, 1, 1)
    assert got[1] == dt.datetime(2024, 1, 1)
    assert got[2] == dt.datetime(2024, 1, 4, 15)


def test_count_when_is_null_on_empty(spark):
    df = spark.createDataFrame([], "x bigint")
    assert df.agg(C.count_when(F.col("x") > 0)).collect()[0][0] is None


def test_tiers_take_the_first_matching_rule(spark):
    """Bounds written out here, not taken from the tables under test."""
    from lodgeflow.functions.tiers import tier
    from lodgeflow.operators import lineage as G
    from lodgeflow.plans import models as M
    want = {
        M.NIGHTS_CATEGORY: {None: "30+ nights", 1: "1 night", 2: "2-3 nights", 3: "2-3 nights", 4: "4-7 nights",
                            7: "4-7 nights", 8: "8-14 nights", 14: "8-14 nights", 15: "15-30 nights",
                            30: "15-30 nights", 31: "30+ nights", 0: "30+ nights"},
        M.STAY_TYPE: {None: "Long-term", 3: "Short-term", 4: "Medium-term", 14: "Medium-term", 15: "Long-term"},
        M.PRICE_CATEGORY: {None: "Premium", 49: "Budget", 50: "Mid-range", 150: "Mid-range", 151: "Premium"},
        G.CRITICALITY: {0: "leaf", 1: "low_impact", 3: "medium_impact", 7: "high_impact", 8: "critical"},
        G.RISK_BASE: {0: 0, 1: 2, 2: 4, 3: 4, 4: 6, 7: 6, 8: 8, 10: 8, 11: 10},
        G.FANOUT: {0: "No Fanout", 1: "Low Fanout", 2: "Medium Fanout", 3: "Medium Fanout", 4: "High Fanout"},
    }
    for table, cases in want.items():
        df = spark.createDataFrame([(v,) for v in cases], "v bigint")
        assert [r[0] for r in df.select(tier(F.col("v"), *table)).collect()] == list(cases.values())
