"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Prints one line per query: status, row counts, and the first difference.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return bool(v)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from lodgeflow.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            snames = df.columns
        except Exception as exc:  # noqa: BLE001
            print(f"SPARK-ERROR {k}: {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in sql:
            print(f"rows-only  {k}: spark={len(srows)} ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(sql[k])
            dnames = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as exc:  # noqa: BLE001
            print(f"DUCK-ERROR {k}: {type(exc).__name__}: {str(exc)[:400]}")
            bad += 1
            continue
        sn, sr = canon(snames, srows)
        dn, dr = canon(dnames, drows)
        if sn != dn:
            print(f"SCHEMA     {k}: spark={sn} duck={dn}")
            bad += 1
            continue
        hs = hashlib.md5(repr(sr).encode()).hexdigest()
        hd = hashlib.md5(repr(dr).encode()).hexdigest()
        if len(sr) != len(dr) or hs != hd:
            diff = next(((a, b) for a, b in zip(sr, dr) if a != b), None)
            print(f"MISMATCH   {k}: spark={len(sr)} duck={len(dr)} first diff={diff}")
            bad += 1
        else:
            print(f"ok         {k}: rows={len(sr)} ({ts:.1f}s)")
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
