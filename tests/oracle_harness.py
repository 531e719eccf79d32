"""Compare registered Spark queries against their DuckDB oracle SQL.

Mirrors the driver's gate: same column names, same row count, same
order-insensitive multiset of values. Usage:
    python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duckdb_con(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NaT or v is pd.NA:
            return None
    except Exception:
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    out.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    return cols, out


def compare(spark, con, name: str, sf_dir: str) -> dict:
    import importlib
    entry = importlib.import_module("__spark_entry__")
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    sql = entry.oracle_sql().get(name)
    res = {"name": name, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "no-oracle"
        return res
    dpdf = con.execute(sql).df()
    res["oracle_rows"] = len(dpdf)
    sc, sr = _rows(spdf)
    dc, dr = _rows(dpdf)
    if sc != dc:
        res["status"] = f"columns differ: {sc} vs {dc}"
    elif len(sr) != len(dr):
        res["status"] = "row count differs"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        res["status"] = f"values differ, e.g. {diff}"
    else:
        res["status"] = "match"
    return res


def main(argv):
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from registrar.session import local_session_for_tests
    import __spark_entry__ as entry
    spark = local_session_for_tests(8)
    con = duckdb_con(sf_dir)
    names = names or sorted(entry.queries())
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"error: {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
