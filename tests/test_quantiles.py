"""Parallel exact percentiles against a brute-force expansion."""

import random

import numpy as np
import pytest

from lodgeflow.operators.quantiles import exact_percentiles

PROBS = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]


def test_weighted_percentiles_match_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for g in ["a", "b", "c"]:
        for _ in range(300):
            rows.append((g, float(rng.randint(0, 50)), rng.randint(1, 5)))  # ties across rows
    rows.append(("a", 17.0, 900))        # a hot value holding about a third of group a
    rows.append(("d", 3.5, 1))           # a group of one
    df = spark.createDataFrame(rows, "g string, x double, w bigint").repartition(8)
    got = {r.g: [r[f"q{i}"] for i in range(len(PROBS))]
           for r in exact_percentiles(df, "g", "x", "w", PROBS).collect()}
    for g in ["a", "b", "c", "d"]:
        expanded = np.repeat([r[1] for r in rows if r[0] == g], [r[2] for r in rows if r[0] == g])
        assert got[g] == pytest.approx(list(np.percentile(expanded, [p * 100 for p in PROBS])))


def test_unweighted_and_nulls(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (1, 3.0), (1, 2.0)], "g int, x double")
    r = exact_percentiles(df, "g", "x", None, [0.5, 0.25]).collect()[0]
    assert (r.q0, r.q1) == (2.0, 1.5)


def test_approx_percentiles_close_to_exact(spark):
    from lodgeflow.operators.quantiles import approx_percentiles
    df = spark.range(10000).selectExpr("id % 3 AS g", "CAST(id AS DOUBLE) AS x")
    approx = {r.g: r.q0 for r in approx_percentiles(df, "g", "x", [0.5]).collect()}
    exact = {r.g: r.q0 for r in exact_percentiles(df, "g", "x", None, [0.5]).collect()}
    for g in exact:
        assert abs(approx[g] - exact[g]) <= 10000 / 10000 * 3 + 1


def test_quantile_check_approx_mode(spark):
    from lodgeflow.operators import checks as C
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    assert C.quantile_between(df, "x", 0.99, 50, 500, approx=True).count() == 0
    assert C.quantile_between(df, "x", 0.99, 100, 500, approx=True).count() == 1


def test_null_group_hot_value_and_no_exchange_reuse(spark):
    """The result may not depend on an optimiser rule; a NULL group is a group."""
    df = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL ELSE CAST(id % 3 AS string) END AS g",
        "CASE WHEN id % 10 < 7 THEN 5.0D ELSE CAST(id AS double) END AS x").repartition(6)
    plain = df.toPandas()
    want = {None if g is None else g: float(np.percentile(plain[plain.g.isna() if g is None else plain.g == g].x, 90))
            for g in (None, "1", "2")}
    before = spark.conf.get("spark.sql.exchange.reuse")
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = {r.g: r.q0 for r in exact_percentiles(df, "g", "x", None, [0.9]).collect()}
        finally:
            spark.conf.set("spark.sql.exchange.reuse", before)
        assert got == pytest.approx(want)
