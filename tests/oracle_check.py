"""Run every registered query in Spark and its oracle in DuckDB; compare like the driver does
(row count, column names, order-insensitive value hash). Usage: python tests/oracle_check.py [sf_dir] [keys...]"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "item"):
        return norm(v.item())
    return repr(v)


def digest(rows):
    hs = sorted(hashlib.sha1("|".join(norm(x) for x in r).encode()).hexdigest() for r in rows)
    return hashlib.sha1("".join(hs).encode()).hexdigest()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, keys=None):
    import __spark_entry__ as se

    qs, os_ = se.queries(), se.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for k in keys or qs:
        t = time.time()
        df = qs[k](spark, sf_dir)
        cols = sorted(df.columns)
        srows = [tuple(r[c] for c in cols) for r in df.collect()]
        ts = time.time() - t
        if k not in os_:
            out[k] = ("rows-only", len(srows), ts)
            continue
        rel = con.execute(os_[k])
        dcols = [d[0] for d in rel.description]
        drows_raw = rel.fetchall()
        idx = [dcols.index(c) if c in dcols else None for c in cols]
        if None in idx or sorted(dcols) != cols:
            out[k] = (f"COLUMNS spark={cols} duck={sorted(dcols)}", len(srows), ts)
            continue
        drows = [tuple(r[i] for i in idx) for r in drows_raw]
        ok = len(srows) == len(drows) and digest(srows) == digest(drows)
        out[k] = ("ok" if ok else f"MISMATCH spark={len(srows)} duck={len(drows)}", len(srows), ts)
        if not ok:
            ss, ds = set(srows), set(drows)
            print(k, "only spark:", list(ss - ds)[:3], "\n   only duck:", list(ds - ss)[:3])
    return out


if __name__ == "__main__":
    from lineweave.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    for k, v in res.items():
        print(f"CHECK {k:30s} {v[0]:10s} rows={v[1]} {v[2]:.1f}s")
