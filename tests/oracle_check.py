"""Side-by-side check of ``queries()`` against ``oracle_sql()`` (like the driver).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=_key)


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        if name not in sqls:
            results[name] = f"rows-only {len(srows)}"
            if verbose:
                print(f"{name}: rows-only {len(srows)} ({time.time()-t0:.1f}s)", flush=True)
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCK ERROR {str(e)[:300]}"
            if verbose:
                print(name, results[name], flush=True)
            continue
        sc, sr = canon(scols, srows)
        dc, dr = canon(dcols, drows)
        ok = sc == dc and sr == dr
        msg = "OK" if ok else "MISMATCH"
        if not ok:
            if sc != dc:
                msg += f" cols spark={sc} duck={dc}"
            else:
                a, b = set(sr), set(dr)
                msg += f" rows {len(sr)} vs {len(dr)}; spark-only {list(a - b)[:2]} duck-only {list(b - a)[:2]}"
        results[name] = msg
        if verbose:
            print(f"{name}: {msg} rows={len(srows)} ({time.time()-t0:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    from punctuo.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if not (v == "OK" or v.startswith("rows-only"))]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
