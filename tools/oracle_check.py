"""Run registered queries in Spark and their DuckDB twins; compare results.

Usage: python tools/oracle_check.py [--sf-dir DIR] [key ...]
Comparison: row count, column names, and the multiset of rows after
normalising floats (6 places) and timestamps (ISO text).
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from engram.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "isoformat"):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, key, builder, sql, sf_dir):
    t0 = time.time()
    df = builder(spark, sf_dir)
    scols = df.columns
    srows = [tuple(r) for r in df.collect()]
    ts = time.time() - t0
    if sql is None:
        return dict(key=key, rows=len(srows), status="rows-only", sec=round(ts, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    st = "ok"
    detail = ""
    if sorted(scols) != sorted(dcols):
        st, detail = "COLS", f"spark={scols} duck={dcols}"
    elif len(srows) != len(drows):
        st, detail = "COUNT", f"spark={len(srows)} duck={len(drows)}"
    else:
        a, b = _rows(scols, srows), _rows(dcols, drows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            st, detail = "VALUES", f"{diff}"
    return dict(key=key, rows=len(srows), status=st, detail=detail[:600], sec=round(ts, 2))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    from engram.plans.registry import all_queries, all_sql
    from engram.session import build_session

    spark = build_session()
    con = duck(a.sf_dir)
    qs, sq = all_queries(), all_sql()
    keys = a.keys or list(qs)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, k, qs[k], sq.get(k), a.sf_dir)
        except Exception as e:  # noqa: BLE001
            r = dict(key=k, status="ERROR", detail=str(e)[:800])
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys) - bad}/{len(keys)} passed")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
