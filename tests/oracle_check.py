"""Compare registered Spark queries with their DuckDB oracle SQL.

Usable from pytest (``compare``) and as a script:
``python tests/oracle_check.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
sys.path.insert(0, ROOT)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "pages")


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), x if x is not None else 0) for x in row)


SPARK_TO_DUCK = {
    "StringType": "VARCHAR", "LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE",
    "DateType": "DATE", "BooleanType": "BOOLEAN", "TimestampNTZType": "TIMESTAMP",
}


def type_mismatches(sdf, rel) -> list:
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    out = []
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(type(f.dataType).__name__, type(f.dataType).__name__)
        if duck_types.get(f.name) != want:
            out.append((f.name, want, duck_types.get(f.name)))
    return out


def compare(spark, con, name: str, build, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = build(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    dcols = list(rel.columns)
    drows = rel.fetchall()
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows), "spark_sec": round(t1 - t0, 2)}
    if sorted(scols) != sorted(dcols):
        out["error"] = f"columns differ: spark={sorted(scols)} oracle={sorted(dcols)}"
        return out
    bad_types = type_mismatches(sdf, rel)
    if bad_types:
        out["error"] = f"types differ (name, spark, oracle): {bad_types}"
        return out
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=_key)
    d = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=_key)
    if s != d:
        diff = [(a, b) for a, b in zip(s, d) if a != b][:3]
        out["error"] = f"values differ ({sum(1 for a, b in zip(s, d) if a != b)} rows); first: {diff}; cols={order}"
    return out


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from rosband.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session(os.environ.get("CHECK_CPUS", "8"), 8)
    con = duck(sf_dir)
    q, o = queries(), oracle_sql()
    bad = 0
    for name in names or list(q):
        if name not in o:
            print(f"{name}: no oracle")
            continue
        try:
            r = compare(spark, con, name, q[name], o[name], sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += "error" in r
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
