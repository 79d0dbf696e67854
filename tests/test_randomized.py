"""Seeded random sequences against plain-Python models of the semantics."""

import datetime as dt
import random
from collections import deque

from lodgeflow.operators import lineage as G
from lodgeflow.operators import scd2 as S

T0 = dt.datetime(2020, 1, 1)


def python_scd2(runs, as_ofs):
    """Reference model of the snapshot rules."""
    hist = []          # dicts: id, v, updated_at, valid_from, valid_to
    for snap, as_of in zip(runs, as_ofs):
        src = {r[0]: r for r in snap}
        open_ = {h["id"]: h for h in hist if h["valid_to"] is None}
        for k, h in open_.items():
            if k not in src:
                h["valid_to"] = as_of
            else:
                _, v, ts = src[k]
                if ts is not None and ts > h["valid_from"]:
                    h["valid_to"] = ts
        for k, (_, v, ts) in src.items():
            h = open_.get(k)
            ended = [x["valid_to"] for x in hist if x["id"] == k]
            if h is None:                      # new, or back after a delete: never before its last end
                begin = max([ts, *ended])
                hist.append({"id": k, "v": v, "updated_at": ts, "valid_from": begin, "valid_to": None})
            elif ts is not None and ts > h["valid_from"]:
                hist.append({"id": k, "v": v, "updated_at": ts, "valid_from": ts, "valid_to": None})
    return sorted((h["id"], h["v"], h["valid_from"], h["valid_to"]) for h in hist)


def test_scd2_random_runs_match_model(spark):
    rng = random.Random(11)
    state = {k: (f"v{k}", T0) for k in range(40)}
    runs, as_ofs = [], []
    for run in range(5):
        snap = []
        for k in range(60):
            if k in state and rng.random() < 0.15:
                del state[k]                                         # hard delete
                continue
            if k not in state:
                if rng.random() < 0.2:                               # new or reappearing key
                    state[k] = (f"n{k}_{run}", T0 + dt.timedelta(days=10 * run + 1))
                continue
            v, ts = state[k]
            r = rng.random()
            if r < 0.2:
                state[k] = (v + "+", ts + dt.timedelta(days=rng.randint(1, 5)))   # newer
            elif r < 0.3:
                state[k] = (v + "~", ts)                             # same timestamp: ignored
            elif r < 0.35:
                state[k] = (v + "-", ts - dt.timedelta(days=1))      # older: ignored
        snap = [(k, v, ts) for k, (v, ts) in sorted(state.items())]
        runs.append(snap)
        as_ofs.append(T0 + dt.timedelta(days=100 + run))
    hist = None
    for snap, as_of in zip(runs, as_ofs):
        df = spark.createDataFrame(snap, "id bigint, v string, updated_at timestamp_ntz")
        hist = S.scd2_apply(hist, df, "id", as_of=as_of.isoformat(sep=" "))
        hist = spark.createDataFrame(hist.collect(), hist.schema)   # cut lineage between runs
    got = sorted((r.id, r.v, r.valid_from, r.valid_to) for r in hist.collect())
    assert got == python_scd2(runs, as_ofs)
    assert S.single_active_version(hist, "id").count() == 0


def python_impact(edges):
    children = {}
    nodes = set()
    for p, c in edges:
        children.setdefault(p, set()).add(c)
        nodes |= {p, c}
    out = {}
    for n in nodes:
        seen, depth, q = {}, 0, deque((c, 1) for c in sorted(children.get(n, ())))
        while q:
            x, d = q.popleft()
            if x in seen:
                continue
            seen[x] = d
            for c in sorted(children.get(x, ())):
                if c not in seen:
                    q.append((c, d + 1))
        out[n] = (len(children.get(n, ())), len(seen), max(seen.values(), default=0))
    return out


def test_lineage_random_graphs_match_bfs(spark):
    rng = random.Random(5)
    edges = {(f"m{rng.randint(0, 30)}", f"m{rng.randint(0, 30)}") for _ in range(70)}
    edges = sorted(edges)
    df = spark.createDataFrame(edges, "parent string, child string")
    got = {r.model_name: (r.direct_downstream_count, r.total_downstream_count,
                          r.max_downstream_depth) for r in G.impact(df, exclude_patterns=()).collect()}
    assert got == python_impact(edges)


def test_anomaly_scores_match_pandas(spark):
    import numpy as np
    import pandas as pd

    from lodgeflow.operators import anomaly as A
    rng = random.Random(3)
    rows = []
    for day in range(40):
        for dim in ("a", "b", None):
            if rng.random() < 0.1:
                continue                                            # a missing day → zero
            n = rng.randint(5, 15) + (40 if (dim == "a" and day == 30) else 0)
            rows += [(T0 + dt.timedelta(days=day, hours=rng.randint(0, 23)), dim)] * n
    df = spark.createDataFrame(rows, "ts timestamp_ntz, d string")
    got = {(r.bucket, r.d): (r.row_count, r.training_count, r.z_score, r.anomaly)
           for r in A.anomaly_scores(df, "ts", ["d"], spike_pct=5, drop_pct=5).collect()}

    pdf = pd.DataFrame(rows, columns=["ts", "d"])
    pdf["bucket"] = pdf["ts"].dt.date
    pdf["d"] = pdf["d"].fillna("<null>")
    days = pd.date_range(pdf["bucket"].min(), pdf["bucket"].max()).date
    want = {}
    for dim in pdf["d"].unique():
        counts = pdf[pdf["d"] == dim].groupby("bucket").size().reindex(days, fill_value=0)
        prev = counts.shift(1)
        avg = prev.rolling(14, min_periods=1).mean()
        sd = prev.rolling(14, min_periods=2).std()
        cnt = prev.rolling(14, min_periods=1).count()
        for day, n, a, s, c in zip(days, counts, avg, sd, cnt):
            if c < 7:
                continue
            z = (n - a) / s if s > 0 else None
            pct = (n - a) * 100 / a if a else None
            flat = not (s > 0)
            spike = n > a and (flat or z > 3) and (pct is None or pct > 5)
            drop = n < a and (flat or z < -3) and (pct is None or -pct > 5)
            key = (day, None if dim == "<null>" else dim)
            want[key] = (int(n), int(c), None if z is None else round(z, 4),
                         "spike" if spike else ("drop" if drop else None))
    assert set(got) == set(want)
    for k in want:
        g, w = got[k], want[k]
        assert g[:2] == w[:2] and g[3] == w[3], k
        assert (g[2] is None and w[2] is None) or abs(g[2] - w[2]) < 1e-3, k
    assert any(v[3] == "spike" for v in got.values())


def test_column_profile_matches_pandas(spark):
    import pandas as pd

    from lodgeflow.operators import profile as P
    rng = random.Random(9)
    words = ["a", "b b", " ", "", "x1", "123", "Zz", None]
    rows = [(rng.choice([None, rng.randint(-5, 5)]), rng.choice(words),
             rng.choice([None, rng.random() * 100])) for _ in range(500)]
    df = spark.createDataFrame(rows, "i bigint, s string, f double")
    got = {r.column_name: r for r in P.column_profile(df).collect()}
    pdf = pd.DataFrame(rows, columns=["i", "s", "f"])
    for c in ("i", "s", "f"):
        col = pdf[c]
        assert got[c].null_count == int(col.isna().sum())
        assert got[c].distinct_count == int(col.dropna().nunique())
    for c in ("i", "f"):
        x = pdf[c].dropna().astype(float)
        r = got[c]
        assert r.min == x.min() and r.max == x.max()
        assert abs(r.avg - x.mean()) < 1e-9 and abs(r.stddev - x.std()) < 1e-9
        q = x.quantile([0.25, 0.5, 0.75]).tolist()
        assert [r.p25, r.median, r.p75] == [round(v, 12) for v in q] or \
            all(abs(a - b) < 1e-9 for a, b in zip([r.p25, r.median, r.p75], q))
        assert r.outlier_count == int(((x - x.mean()).abs() > 3 * x.std()).sum())
    s = pdf["s"].dropna()
    r = got["s"]
    assert r.empty_count == int((s == "").sum())
    assert r.whitespace_only_count == int(((s.str.strip(" ") == "") & (s != "")).sum())
    assert r.numeric_pattern_count == int(s.str.fullmatch(r"[0-9]+").sum())
    assert r.alpha_pattern_count == int(s.str.fullmatch(r"[A-Za-z\s]+").sum())
    counts = s.value_counts()
    assert r.mode == sorted(counts[counts == counts.max()].index)[0]
    assert abs(r.avg_length - s.str.len().mean()) < 1e-9


def test_profile_approx_percentiles_close_and_moments_exact(spark):
    from lodgeflow.operators import profile as P
    rng = random.Random(21)
    rows = [(rng.randint(0, 1000), rng.random() * 50) for _ in range(3000)]
    df = spark.createDataFrame(rows, "i bigint, f double")
    exact = {r.column_name: r for r in P.column_profile(df).collect()}
    approx = {r.column_name: r for r in P.column_profile(df, approx_percentiles=True).collect()}
    for c, spread in (("i", 1000), ("f", 50)):
        e, a = exact[c], approx[c]
        assert (a.min, a.max, a.outlier_count) == (e.min, e.max, e.outlier_count)
        assert abs(a.avg - e.avg) < 1e-9 and abs(a.stddev - e.stddev) < 1e-9
        for qa, qe in ((a.p25, e.p25), (a.median, e.median), (a.p75, e.p75)):
            assert abs(qa - qe) <= spread * 0.01
