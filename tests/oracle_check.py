"""Compare registered Spark queries with their DuckDB twins.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, column match, value match.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import numbers
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return "∅"
    if isinstance(v, float) and math.isnan(v):
        return "∅"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, (numbers.Number, decimal.Decimal)):
        f = float(v)
        return "%.6f" % round(f, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    out.sort()
    return cols, out


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = True) -> dict:
    import __spark_entry__ as E
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = E.queries()[name](spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    res = {"name": name, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    dpdf = con.execute(sql).df()
    res["oracle_rows"] = len(dpdf)
    sc, sr = rows_of(spdf)
    dc, dr = rows_of(dpdf)
    res["cols_ok"] = sc == dc
    res["values_ok"] = sc == dc and sr == dr
    if verbose and not res["values_ok"]:
        if sc != dc:
            print("  spark cols", sc, "\n  duck  cols", dc)
        else:
            a, b = set(sr), set(dr)
            print("  only spark:", sorted(a - b)[:3])
            print("  only duck :", sorted(b - a)[:3])
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from martflow.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    names = names or list(E.queries())
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as ex:  # report and continue
            r = {"name": n, "error": repr(ex)[:400]}
        ok = r.get("values_ok", r.get("oracle") == "none")
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
