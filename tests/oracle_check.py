"""Run registered queries and their SQL twins side by side (what the driver's
correctness gate does): row count, column names and an order-insensitive
comparison of values. Usage: python tests/oracle_check.py [sf_dir] [key ...]"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    import datetime
    import decimal
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: {sorted(spark_cols)} vs {sorted(duck_cols)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=repr)
    if len(a) != len(b):
        return f"rows differ: {len(a)} vs {len(b)}"
    exact = a == b
    if exact:
        return None
    for x, y in zip(a, b):
        if x != y:
            return f"first diff: {x} vs {y}"
    return "differ"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    from segmint.session import get_spark
    spark = get_spark()
    con = duck(sf_dir)
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for k in (keys or sorted(qs)):
        t = time.time()
        try:
            df = qs[k](spark, sf_dir)
            rows = df.collect()
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t
        if k not in sql:
            print(f"{k:28s} rows-only {len(rows)} rows  {ts:.1f}s")
            continue
        try:
            cur = con.execute(sql[k])
            drows = cur.fetchall()
            dcols = [d[0] for d in cur.description]
        except Exception as e:  # noqa: BLE001
            print(f"{k:28s} SQL ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        msg = compare(rows, cols, drows, dcols)
        print(f"{k:28s} {'OK ' if msg is None else 'BAD'} {len(rows)} rows {ts:.1f}s {msg or ''}")
        bad += msg is not None
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
