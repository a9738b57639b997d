"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Comparison: columns sorted by name, rows as an order-free multiset of
normalized values (floats to 9 significant digits, NULL/NaN alike).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return "NULL"
    try:
        import pandas as pd

        if v is pd.NA or v is pd.NaT:
            return "NULL"
    except Exception:
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{v:.9g}"
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def frame_rows(pdf):
    cols = sorted(pdf.columns)
    pdf = pdf[cols]
    return cols, sorted(tuple(norm(v) for v in row) for row in pdf.itertuples(index=False, name=None))


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    s_pdf = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(s_pdf), spark_s=round(t1 - t0, 2))
    d_pdf = con.execute(sql).df()
    t2 = time.time()
    sc, sr = frame_rows(s_pdf)
    dc, dr = frame_rows(d_pdf)
    ok = sc == dc and sr == dr
    info = dict(name=name, ok=ok, rows=len(sr), oracle_rows=len(dr), spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2))
    if not ok:
        info["cols"] = (sc, dc) if sc != dc else None
        diff_s = sorted(set(sr) - set(dr))[:3]
        diff_d = sorted(set(dr) - set(sr))[:3]
        info["only_spark"] = diff_s
        info["only_oracle"] = diff_d
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from eventweave.plans.catalog import REGISTRY
    from eventweave.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for name, q in REGISTRY.items():
        if names and name not in names:
            continue
        try:
            info = compare(spark, con, sf_dir, name, q.build, q.sql)
        except Exception as e:  # report and continue
            info = dict(name=name, ok=False, error=repr(e)[:600])
        if info.get("ok") is False:
            bad += 1
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
