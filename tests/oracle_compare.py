"""Compare catalogue queries with their DuckDB oracles (row count, column
names, order-insensitive multiset of values).

Usable from tests and from the command line:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

VIEWS = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return [columns[i] for i in order], out


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for v in VIEWS:
        path = f"{sf_dir}/{v}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, sf_dir: str, names=None) -> dict[str, dict]:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        s_cols, s_rows = normalise(df.columns, [tuple(r) for r in df.collect()])
        t1 = time.time()
        entry = {"spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
        if name in sqls:
            cur = con.execute(sqls[name])
            d_cols = [c[0] for c in cur.description]
            d_cols, d_rows = normalise(d_cols, cur.fetchall())
            entry.update(
                oracle_rows=len(d_rows),
                columns_match=s_cols == d_cols,
                values_match=s_rows == d_rows,
            )
            if s_cols != d_cols:
                entry["columns"] = (s_cols, d_cols)
            elif s_rows != d_rows:
                a, b = set(s_rows), set(d_rows)
                entry["only_spark"] = sorted(a - b, key=_key)[:3]
                entry["only_oracle"] = sorted(b - a, key=_key)[:3]
        report[name] = entry
    return report


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    rep = compare(spark, sf, sys.argv[2:] or None)
    bad = 0
    for k, v in rep.items():
        ok = v.get("values_match", None)
        bad += ok is False
        print(("PASS" if ok else "NOSQL" if ok is None else "FAIL"), k, v)
    print("failures:", bad)
