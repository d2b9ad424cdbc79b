"""Run registered queries in Spark and their DuckDB oracles side by side.

Mirrors the driver's check: same column names, same row count, same
order-insensitive multiset of rows (floats compared after rounding).

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [name ...]
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


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _kind(t: str) -> str:
    t = t.lower()
    if any(k in t for k in ("int", "long", "short", "byte")):
        return "int"
    if any(k in t for k in ("double", "float", "decimal")):
        return "float"
    if "timestamp" in t:
        return "ts"
    if "date" in t:
        return "date"
    if "bool" in t:
        return "bool"
    if "char" in t or "string" in t:
        return "str"
    return t


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf_dir}/{f}')")
    return con


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from pelagic.plans.catalog import ORACLES, QUERIES
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    stypes = {f.name: _kind(f.dataType.simpleString()) for f in sdf.schema.fields}
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if name not in ORACLES:
        res["status"] = "rows-only"
        return res
    con.execute(f"CREATE OR REPLACE VIEW oracle_of_{name} AS {ORACLES[name]}")  # a view, as the driver stores it
    rel = con.sql(f"SELECT * FROM oracle_of_{name}")
    dcols = rel.columns
    dtypes = {c: _kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    drows = rel.fetchall()
    res["oracle_rows"] = len(drows)
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={scols} oracle={dcols}")
    else:
        for c in scols:
            if stypes[c] != dtypes[c]:
                problems.append(f"type {c}: spark={stypes[c]} oracle={dtypes[c]}")
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        a = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=repr)
        b = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=repr)
        if len(a) != len(b):
            problems.append(f"rows spark={len(a)} oracle={len(b)}")
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            sa, sb = set(a), set(b)
            problems.append(f"values differ; only-spark={list(sa - sb)[:3]} only-oracle={list(sb - sa)[:3]} first={diff}")
    res["status"] = "ok" if not problems else "MISMATCH"
    if problems:
        res["problems"] = problems
    return res


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from pelagic.session import get_session
    from pelagic.plans.catalog import QUERIES, load_all
    load_all()
    spark = get_session(shuffle_partitions=8)
    con = duck(args.sf)
    names = args.names or sorted(QUERIES)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, args.sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "ERROR", "error": repr(e)[:600]}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} fine")


if __name__ == "__main__":
    main()
