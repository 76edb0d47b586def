"""Run every registered query in Spark and its SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per query: rows, columns, value match, and dtypes on mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    from tripmart.session import get_spark

    extra = {}
    if os.environ.get("CHECK_SESSION_TZ"):
        extra["spark.sql.session.timeZone"] = os.environ["CHECK_SESSION_TZ"]
    spark = get_spark("local[8]", shuffle_partitions=8, extra_conf=extra)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        t1 = time.time()
        if name not in sqls:
            print(f"{name:28s} spark rows={len(srows):7d} (no oracle) {t1-t0:.1f}s")
            continue
        res = con.execute(sqls[name])
        dcols = [d[0] for d in res.description]
        drows = res.fetchall()
        ok_cols = sorted(scols) == sorted(dcols)
        ok_rows = len(srows) == len(drows)
        ok_vals = ok_cols and canon(srows, scols) == canon(drows, dcols)
        status = "OK " if (ok_cols and ok_rows and ok_vals) else "BAD"
        bad += status == "BAD"
        print(f"{status} {name:28s} rows s={len(srows)} d={len(drows)} cols={ok_cols} "
              f"vals={ok_vals} {t1-t0:.1f}s")
        if status == "BAD":
            print("   spark:", [(f.name, f.dataType.simpleString()) for f in df.schema.fields])
            print("   duck :", list(zip(dcols, [str(d[1]) for d in res.description])))
            if ok_cols:
                a, b = canon(srows, scols), canon(drows, dcols)
                sa, sb = set(a), set(b)
                print("   only spark:", list(sa - sb)[:3])
                print("   only duck :", list(sb - sa)[:3])
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
