"""Run registered queries in Spark and their oracle SQL in DuckDB, compare
row count, column names and order-insensitive values (floats rounded).

    python tools/oracle_check.py [--sf /root/testdata/sf0.01] [key ...]
"""

from __future__ import annotations

import argparse
import json
import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from locusframe.fixtures import BASE_TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 5)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=repr)
    return [cols[i] for i in order], out


def duck(sf_dir):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, spec, sf_dir):
    t0 = time.time()
    df = spec.run(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    ts = time.time() - t0
    res = {"key": spec.key, "spark_rows": len(srows), "spark_sec": round(ts, 2)}
    if not spec.sql:
        res["status"] = "rows-only"
        return res
    t1 = time.time()
    cur = con.execute(spec.sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res["duck_sec"] = round(time.time() - t1, 2)
    res["duck_rows"] = len(drows)
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    if sc != dc:
        res["status"] = "COLS"
        res["detail"] = {"spark": sc, "duck": dc}
    elif len(sr) != len(dr):
        res["status"] = "ROWS"
    elif sr != dr:
        res["status"] = "VALUES"
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        res["detail"] = [list(map(repr, x)) for x in diff]
    else:
        res["status"] = "ok"
    return res


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=None)
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    from locusframe.catalog import load_all
    from locusframe.session import build_session
    spark = build_session()
    con = duck(a.sf)
    reg = load_all()
    keys = a.keys or list(reg)
    results = []
    for k in keys:
        try:
            r = compare(spark, con, reg[k], a.sf)
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "status": "ERROR", "detail": f"{type(e).__name__}: {str(e)[:600]}"}
        results.append(r)
        print(json.dumps(r), flush=True)
    bad = [r["key"] for r in results if r["status"] not in ("ok", "rows-only")]
    print(f"# {len(results)} checked, {len(bad)} failing: {bad}")
    if a.out:
        with open(a.out, "w") as fh:
            json.dump(results, fh, indent=1)


if __name__ == "__main__":
    main()
