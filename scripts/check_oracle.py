"""Run registered queries on Spark and their SQL oracles on DuckDB, and compare.

usage: python scripts/check_oracle.py [sf_dir] [name ...]

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of values (columns sorted by name, rows sorted).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from myosig.plans import all_queries  # noqa: E402
from myosig.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None  # pandas turns NULL in numeric columns into NaN
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(norm(v) for v in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    if os.environ.get("PLAIN_SESSION"):
        # the driver's situation: a default session, none of our settings
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = local_session()
    con = duck(sf_dir)
    qs = all_queries()
    names = args or list(qs)
    bad = 0
    for name in names:
        q = qs[name]
        t0 = time.time()
        try:
            sdf = q.build(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not q.sql:
            print(f"ROWS {name}: {len(sdf)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            odf = con.execute(q.sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = rows_of(sdf)
        oc, orr = rows_of(odf)
        if sc != oc:
            print(f"FAIL {name}: columns {sc} vs {oc}")
            bad += 1
            continue
        if len(sr) != len(orr):
            print(f"FAIL {name}: rows {len(sr)} vs {len(orr)}")
            bad += 1
            continue
        diff = [(a, b) for a, b in zip(sr, orr) if a != b]
        if diff:
            print(f"FAIL {name}: {len(diff)} differing rows, e.g. {diff[0][0]} vs {diff[0][1]}")
            bad += 1
            continue
        print(f"OK   {name}: {len(sr)} rows {ts:.1f}s")
    print(f"{len(names) - bad}/{len(names)} ok")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
