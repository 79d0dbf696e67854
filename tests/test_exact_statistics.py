"""Histogram refinement, proven modes and mergeable profiles against plain Python."""

import decimal
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeflow.operators import frequent, profile, profile_store, quantiles
from lodgeflow.operators.load import write_table


def ranks_of(spark, rows, kind, probs, monkeypatch=None, sort_at=None, buckets=None):
    if sort_at is not None:
        monkeypatch.setattr(quantiles, "SORTED", sort_at)
        monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    df = spark.createDataFrame(rows, f"g string, x {kind}, w bigint").repartition(5)
    got = {(r.g, r.k): (r.n, r.value) for r in quantiles.select_ranks(df, probs).collect()}
    for g in {r[0] for r in rows}:
        order = sorted((x for h, x, w in rows if h == g for _ in range(w)), key=lambda v: (isinstance(v, float) and math.isnan(v), v))
        n = len(order)
        for p in probs:
            for k in {math.floor(p * (n - 1)), math.ceil(p * (n - 1))}:
                value = got.pop((g, k), None)
                if value is None:  # two probabilities may share a rank
                    continue
                assert value[0] == n
                assert value[1] == order[k] or (math.isnan(value[1]) and math.isnan(order[k])), (g, k)
    assert not got


PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("sort_at,buckets", [(65_536, 4096), (3, 4)])
def test_ranks_of_whole_numbers_beyond_doubles(spark, monkeypatch, sort_at, buckets):
    rng = random.Random(1)
    big = 2 ** 53
    rows = [("a", big + rng.randrange(200), rng.randrange(1, 4)) for _ in range(200)]
    rows += [("b", rng.choice([-1, 1]) * rng.randrange(2 ** 63 - 1), 1) for _ in range(150)]
    rows += [("b", -2 ** 63, 1), ("b", 2 ** 63 - 1, 1), (None, 7, 3), ("one", 5, 1)]
    rows += [("hot", 11, 1000), ("hot", 10, 1), ("hot", 12, 500)]
    ranks_of(spark, rows, "bigint", PROBS, monkeypatch, sort_at, buckets)


@pytest.mark.parametrize("sort_at,buckets", [(65_536, 4096), (3, 4)])
def test_ranks_of_awkward_doubles(spark, monkeypatch, sort_at, buckets):
    rng = random.Random(2)
    rows = [("a", rng.gauss(0, 1) * 10 ** rng.randrange(-30, 30), 1) for _ in range(120)]
    rows += [("b", x, 2) for x in (math.inf, -math.inf, 1.0, 2.0, 1e308, -1e308, 5e-324, 0.0)]
    rows += [("c", x, 1) for x in (math.nan, 1.0, 2.0, math.nan, 3.0)]
    ranks_of(spark, rows, "double", PROBS, monkeypatch, sort_at, buckets)


def test_ranks_of_decimals(spark, monkeypatch):
    rng = random.Random(3)
    rows = [("a", decimal.Decimal(rng.randrange(10 ** 20)).scaleb(-2), 1) for _ in range(100)]
    ranks_of(spark, rows, "decimal(22,2)", PROBS, monkeypatch, 3, 4)


def test_percentiles_neither_sort_nor_sample_all_rows(spark, monkeypatch):
    """Only rows of narrow ranges are shuffled, and none by range."""
    plans = []
    keep = quantiles.reliable_checkpoint
    monkeypatch.setattr(quantiles, "reliable_checkpoint",
                        lambda df: (plans.append(df._jdf.queryExecution().toString()), keep(df))[1])
    df = spark.range(20_000).selectExpr("0 AS g", "CAST(id * 7 % 20011 AS double) AS x")
    got = quantiles.exact_percentiles(df, "g", "x", None, [0.5]).first()
    assert got.q0 == float(np.median([i * 7 % 20011 for i in range(20_000)]))
    assert not any("rangepartitioning" in p for p in plans)


# --- modes ------------------------------------------------------------------------------
def modes(spark, columns, tracked=frequent.TRACKED):
    names = [f"c{i}" for i in range(len(columns))]
    df = spark.createDataFrame(list(zip(*columns)), ", ".join(f"{n} string" for n in names)).repartition(4)
    got = {r.column_name: (r.mode, r.mode_count) for r in frequent.exact_modes(df, names, tracked).collect()}
    for n, column in zip(names, columns):
        count = Counter(v for v in column if v is not None)
        most = max(count.values(), default=0)
        want = (min(v for v, k in count.items() if k == most), most) if count else None
        assert got.get(n) == want, n


def test_modes_proven_and_counted(spark):
    rng = random.Random(5)
    n = 4000
    modes(spark, [
        [rng.choice(["b", "a", None, "c"]) for _ in range(n)],                      # few values
        [f"v{i}" for i in range(n)],                                             # all different
        [f"v{i // 2}" for i in range(n)],                                        # all tied at two
        ["hot" if i % 10 < 3 else f"v{i}" for i in range(n)],                    # a hot value among many
        ["x" if i % 2 else "y" for i in range(n)],                               # a tie of hot values
        [None] * n, [None] * (n - 1) + [""],
        [f"v{int(rng.paretovariate(0.6))}" for _ in range(n)]], tracked=100)


def test_small_error_share():
    assert frequent.error_share(10_000) == 7 / 16_384 and frequent.error_share(96) == 7 / 128


def test_a_proven_mode_is_not_counted_in_full(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(frequent, "counted_modes", lambda df, columns: asked.append(columns))
    df = spark.range(30_000).selectExpr("IF(id % 5 = 0, 'hot', CAST(id AS string)) AS c")
    assert [tuple(r) for r in frequent.exact_modes(df, ["c"]).collect()] == [("c", "hot", 6000)]
    assert not asked


# --- exact profile ------------------------------------------------------------------------
def test_profile_keeps_big_numbers(spark):
    big = 9_007_199_254_740_993
    df = spark.createDataFrame([(big, decimal.Decimal("12345678901234567890.12")), (big + 2, None), (None, decimal.Decimal("1.10"))],
                               "i bigint, d decimal(22,2)")
    p = {r.column_name: r for r in profile.column_profile(df).collect()}
    assert (p["i"].min_exact, p["i"].max_exact) == (str(big), str(big + 2))
    assert (p["d"].min_exact, p["d"].max_exact) == ("1.10", "12345678901234567890.12")
    w = profile.profile_table(df, "m", as_of="2024-01-01 00:00:00").first()
    assert w.i_min == big and w.i_max == big + 2 and w.d_max == decimal.Decimal("12345678901234567890.12")
    assert w.profile_hash == profile.profile_table(df, "m", as_of="2024-02-01 00:00:00").first().profile_hash


# --- mergeable profiles -------------------------------------------------------------------------
def events(spark, days, scale=1):
    n = 3000 * scale
    return spark.range(n).selectExpr(
        "id", f"concat('2024-01-', lpad(CAST(id % {days} + 1 AS string), 2, '0'), 'd') AS day",
        "CAST(id * 1000003 % 1000 AS string) AS thousand", "CAST(id % 10 AS string) AS ten", "CAST(id % 11 AS int) AS eleven",
        "IF(id % 4 = 0, NULL, 'same') AS same", "CAST(id % 100 AS decimal(9,2)) AS hundred", "id % 3 = 0 AS flag",
        "CAST(NULL AS double) AS nothing", "IF(id = 5, '  ', concat('x', id)) AS text")


def test_merged_profile_equals_the_whole_table(spark, scratch):
    write_table(events(spark, 7), f"{scratch}/t", partition_by=["day"])
    table = spark.read.parquet(f"{scratch}/t")
    first = profile_store.profile_new_partitions(spark, f"{scratch}/s", table.filter("day < '2024-01-04d'"), "day", "1")
    rest = profile_store.profile_new_partitions(spark, f"{scratch}/s", table, "day", "2")
    assert len(first) == 3 and len(rest) == 4 and not set(first) & set(rest)
    assert profile_store.profile_new_partitions(spark, f"{scratch}/s", table, "day", "3") == []
    got = {r.column_name: r for r in profile_store.merged_profile(spark, f"{scratch}/s", table).collect()}
    want = {r.column_name: r for r in profile.column_profile(table.drop("day")).collect()}
    assert set(got) == set(want)
    for name, w in want.items():
        g = got[name]
        for c in ("total_rows", "null_count", "completeness_rate", "cardinality_category", "min_exact", "max_exact",
                  "min_length", "max_length", "avg_length", "empty_count", "whitespace_only_count",
                  "numeric_pattern_count", "alpha_pattern_count", "true_count", "false_count"):
            assert getattr(g, c) == getattr(w, c) or (w.family != "numeric" and c.endswith("_exact")), (name, c)
        # the error bound holds, and a count that is given is exact
        assert g.distinct_low <= w.distinct_count <= g.distinct_high, name
        assert g.distinct_count in (None, w.distinct_count), name
        if w.family == "numeric" and w.avg is not None:
            assert g.avg == pytest.approx(w.avg)
    # well inside its class: not counted in the table; near a bound: counted
    assert got["thousand"].distinct_count is None and got["ten"].distinct_count == 10 and got["eleven"].distinct_count == 11


def test_sketch_bound_on_many_values(spark, scratch):
    write_table(events(spark, 5, scale=40), f"{scratch}/t", partition_by=["day"])
    table = spark.read.parquet(f"{scratch}/t")
    profile_store.profile_new_partitions(spark, f"{scratch}/s", table, "day", "1")
    got = {r.column_name: r for r in profile_store.merged_profile(spark, f"{scratch}/s", table).collect()}
    assert got["text"].distinct_low <= 120_000 <= got["text"].distinct_high and got["text"].cardinality_category == "UNIQUE"
    assert abs(got["id"].distinct_estimate - 120_000) < 4 * profile_store.STANDARD_ERROR * 120_000


def test_old_partitions_are_not_read(spark, scratch):
    """The files of a profiled partition may even be gone."""
    import glob
    import os

    write_table(events(spark, 3), f"{scratch}/t", partition_by=["day"])
    table = spark.read.parquet(f"{scratch}/t")
    profile_store.profile_new_partitions(spark, f"{scratch}/s", table.filter("day = '2024-01-01d'"), "day", "1")
    for f in glob.glob(f"{scratch}/t/day=2024-01-01d/*.parquet"):
        os.truncate(f, 4)
    # the list of partitions comes from the caller's table, whose first day cannot be opened any more
    rest = table.filter("day > '2024-01-01d'")
    assert len(profile_store.profile_new_partitions(spark, f"{scratch}/s", rest, "day", "2")) == 2
    got = profile_store.merged_profile(spark, f"{scratch}/s").filter("column_name = 'id'").first()
    assert got.total_rows == 3000 and got.min_exact == "0" and got.max_exact == "2999"


def test_changed_partitions_replace_their_state(spark, scratch):
    table = spark.createDataFrame([("p", 1), ("p", 2), ("q", 3), (None, 4)], "part_of string, x int")
    assert profile_store.profile_new_partitions(spark, f"{scratch}/s", table, "part_of", "1") == ["NULL", "p", "q"]
    changed = spark.createDataFrame([("p", 10), ("q", 3), (None, 4)], "part_of string, x int")
    assert profile_store.profile_new_partitions(spark, f"{scratch}/s", changed, "part_of", "2", ["p"]) == ["p"]
    got = profile_store.merged_profile(spark, f"{scratch}/s", changed).first()
    assert (got.total_rows, got.min_exact, got.max_exact, got.cardinality_category) == (3, "3", "10", "UNIQUE")


@pytest.mark.parametrize("keys", [[1, 2, 3, 40, None], [5_000_000, 7, 7, 921_436, 921_437], [2**63 - 1, -2**63, 0, 5, 6]])
def test_big_integers_beyond_a_long_stay_exact(spark, scratch, keys):
    """Keys whose large multiples a long cannot hold are profiled to the last digit."""
    from lodgeflow.plans import registry

    spark.createDataFrame([(k,) for k in keys], "l_orderkey long").write.parquet(f"{scratch}/lineitem.parquet")
    row = registry.queries()["profile_big_integers"](spark, scratch).first()
    big = sorted(k * registry.BIG_FACTOR + registry.BIG_BASE for k in keys if k is not None)
    low = [big[math.floor(p * (len(keys) - 1))] for p in (0.25, 0.5, 0.75)]  # ranks count rows without a key, which come last
    assert [int(row[c]) for c in ("min", "max", "distinct_count", "p25_low", "median_low", "p75_low")] == [
        big[0], big[-1], len(set(big)), *low]


def test_value_tops_against_counts(spark):
    rows = [(1, "x", None), (1, "y", 2.5), (None, "y", 2.5), (7, None, -0.5), (7, "z", 2.5), (7, "z", None)]
    df = spark.createDataFrame(rows, "n int, s string, d double")
    cols = profile.column_families(df)
    tops = profile.value_tops(df, cols, row_hash=True)
    for i, (name, _) in enumerate(cols):
        counts = Counter(r[i] for r in rows if r[i] is not None)
        most = max(counts.values())
        assert tops[name][:3] == (len(counts), most, sum(n == most for n in counts.values()))
    assert (tops["n"][3]["a"], tops["n"][3]["b"]) == (7, 0)  # a whole number is its own key
    assert tops[profile.ROW_KEY][:3] == (6, 1, 6)


@pytest.mark.parametrize("query", ["profile_rows", "profile_wide"])
def test_the_fact_is_read_again_not_stored(spark, scratch, monkeypatch, query):
    from lodgeflow.plans import registry

    rows = [(k % 5, k % 3, k % 2, 1 + k % 7, "ANR"[k % 3], "O") for k in range(60)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, "
                                "l_linestatus string").withColumn("l_shipdate", F.expr(
                                    "timestamp_ntz '1996-01-01' + make_interval(0, 0, 0, cast(l_orderkey as int))")
                                ).write.parquet(f"{scratch}/lineitem.parquet")
    for name, row in (("customer", "c_custkey long, c_name string, c_acctbal double"),
                      ("orders", "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
                      ("events", "ts timestamp_ntz, event_type string")):
        spark.createDataFrame([], row).write.parquet(f"{scratch}/{name}.parquet")
    stored = []
    monkeypatch.setattr(profile, "reliable_checkpoint", lambda df: stored.append(df) or df)
    row = registry.queries()[query](spark, scratch).first()
    fact = [(o, p, s, f, t) for o, p, s, n, f, t in rows if n != 7]
    assert not stored and (row["total_rows"], row["distinct_rows"]) == (len(fact), len(set(fact)))
