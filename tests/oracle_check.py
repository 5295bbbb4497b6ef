"""Spark-vs-DuckDB comparison of registered queries.

Mirrors the driver's gate: column names sorted, row count, order-insensitive
comparison of normalised values (doubles to 6 places), plus a type report.
Run as a script: ``python -m tests.oracle_check [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb
from pyspark.sql import Row
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

_SPARK2DUCK = {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE",
               T.FloatType: "FLOAT", T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN",
               T.TimestampNTZType: "TIMESTAMP", T.ShortType: "SMALLINT", T.DateType: "DATE"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, int):
        return v
    if isinstance(v, Row):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _key(row):
    return repr(row)


def spark_type(t) -> str:
    for k, v in _SPARK2DUCK.items():
        if isinstance(t, k):
            return v
    if isinstance(t, T.ArrayType):
        return spark_type(t.elementType) + "[]"
    return t.simpleString().upper()


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None, verbose=True) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = sdf.collect()
    t1 = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    dtypes = [str(x) for x in rel.types]
    drows = rel.fetchall()
    t2 = time.time()
    scols = sdf.columns
    res = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sorted(scols) != sorted(dcols):
        res["ok"] = False
        res["why"] = f"columns differ: spark={scols} duck={dcols}"
        return res
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    dorder = [dcols.index(scols[i]) for i in order]
    stypes = {f.name: spark_type(f.dataType) for f in sdf.schema.fields}
    tmis = {c: (stypes[c], dtypes[dcols.index(c)]) for c in scols
            if stypes[c] != dtypes[dcols.index(c)] and not (stypes[c].endswith("[]") and dtypes[dcols.index(c)].endswith("[]"))}
    res["type_mismatch"] = tmis
    sv = sorted((tuple(norm(r[i]) for i in order) for r in srows), key=_key)
    dv = sorted((tuple(norm(r[i]) for i in dorder) for r in drows), key=_key)
    res["ok"] = sv == dv
    if not res["ok"]:
        diff = [(a, b) for a, b in zip(sv, dv) if a != b][:2]
        res["why"] = f"values differ; first: {str(diff)[:1500]}"
    return res


def main(argv):
    from quire.plans.catalog import load
    from quire.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    reg = load()
    spark = build_session(8)
    con = duck(sf_dir)
    bad = 0
    for name, (fn, sql) in reg.items():
        if names and name not in names:
            continue
        if sql is None:
            n = fn(spark, sf_dir).count()
            print(f"ROWS  {name}: {n}")
            continue
        try:
            r = compare(spark, name, fn, sql, sf_dir, con)
        except Exception as e:  # noqa: BLE001 - report and continue
            r = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:800]}"}
        bad += not r["ok"]
        tag = "OK   " if r["ok"] else "FAIL "
        print(tag, {k: v for k, v in r.items() if k not in ("ok",) and (v or k == "why")})
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
