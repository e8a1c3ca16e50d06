"""Run registered queries in Spark and their DuckDB oracle side by side.

Usage: python tests/compare.py [sf_dir] [query ...]
Prints one line per query: rows, column match and an order-insensitive value hash match.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    lines = sorted("\x1f".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_names = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("spark-error", repr(e)[:300])
            print(name, "SPARK ERROR", repr(e)[:500])
            continue
        ts = time.time() - t0
        if name not in sql:
            results[name] = ("rows-only", len(s_rows))
            print(f"{name:28s} rows={len(s_rows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(sql[name])
            d_names = list(rel.columns)
            d_rows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("duck-error", repr(e)[:300])
            print(name, "DUCK ERROR", repr(e)[:500])
            continue
        hs, ls = digest(s_names, s_rows)
        hd, ld = digest(d_names, d_rows)
        ok = len(s_rows) == len(d_rows) and sorted(s_names) == sorted(d_names) and hs == hd
        results[name] = ("ok" if ok else "MISMATCH", len(s_rows), len(d_rows))
        print(f"{name:28s} spark={len(s_rows):7d} duck={len(d_rows):7d} cols={'=' if sorted(s_names) == sorted(d_names) else '≠'} "
              f"hash={'=' if hs == hd else '≠'} {ts:.1f}s")
        if not ok and verbose:
            if sorted(s_names) != sorted(d_names):
                print("   spark cols", s_names, "\n   duck cols ", d_names)
            a, b = set(ls), set(ld)
            for x in list(a - b)[:3]:
                print("   only spark:", x[:400])
            for x in list(b - a)[:3]:
                print("   only duck: ", x[:400])
    return results


if __name__ == "__main__":
    from vacanta.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "rows-only")]
    print("BAD:", bad)
