"""Spark-vs-DuckDB comparison used by the tests (and runnable as a script).

Rows are compared as multisets after sorting columns by name, the way the
driver's correctness gate does; floats are compared exactly.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import os
import sys
import time

import duckdb

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((norm(k), norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def spark_rows(df):
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(norm(r[i]) for i in order) for r in df.collect()]
    return [cols[i] for i in order], rows


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(norm(r[i]) for i in order) for r in rel.fetchall()]
    return [cols[i] for i in order], rows


def compare(spark, sf_dir: str, names=None, con=None) -> dict:
    sys.path.insert(0, REPO)
    from __spark_entry__ import oracle_sql, queries
    qs, oracles = queries(), oracle_sql()
    con = con or duck(sf_dir)
    out = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            scols, srows = spark_rows(qs[name](spark, sf_dir))
        except Exception as e:  # noqa: BLE001
            out[name] = {"ok": False, "error": f"spark: {type(e).__name__}: {str(e)[:400]}"}
            continue
        res = {"rows": len(srows), "sec": round(time.time() - t0, 2)}
        if name in oracles:
            try:
                dcols, drows = duck_rows(con, oracles[name])
            except Exception as e:  # noqa: BLE001
                out[name] = {"ok": False, "error": f"duckdb: {type(e).__name__}: {str(e)[:400]}"}
                continue
            res["cols_match"] = scols == dcols
            key = lambda r: json.dumps(r, default=str)
            sa, da = sorted(srows, key=key), sorted(drows, key=key)
            res["rows_match"] = len(sa) == len(da)
            res["values_match"] = sa == da
            res["ok"] = res["cols_match"] and res["values_match"]
            if not res["ok"]:
                res["spark_cols"], res["duck_cols"] = scols, dcols
                diff_s = [r for r in sa if r not in set(da)][:3]
                diff_d = [r for r in da if r not in set(sa)][:3]
                res["spark_only"], res["duck_only"] = diff_s, diff_d
        else:
            res["ok"] = True
            res["oracle"] = None
        out[name] = res
    return out


if __name__ == "__main__":
    sys.path.insert(0, REPO)
    from keelson.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    spark = local_session()
    result = compare(spark, sf, names)
    bad = {k: v for k, v in result.items() if not v.get("ok")}
    for k, v in result.items():
        flag = "OK " if v.get("ok") else "BAD"
        print(flag, k, {x: y for x, y in v.items() if x in ("rows", "sec", "error")})
    for k, v in bad.items():
        print("\n==", k, json.dumps(v, default=str)[:1500])
    print(f"\n{len(result) - len(bad)}/{len(result)} ok")
