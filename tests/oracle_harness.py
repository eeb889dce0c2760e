"""Local twin of the driver's correctness gate: run a registered Spark query and its DuckDB oracle
on the same parquet tables and compare row count, column names and an order-insensitive value
multiset."""

from __future__ import annotations

import math
import sys
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v) -> str:
    if v is None:
        return "NULL"
    try:
        import pandas as pd
        if v is pd.NaT or (not isinstance(v, (str, bytes, list, tuple)) and pd.isna(v)):
            return "NULL"
    except (TypeError, ValueError):
        pass
    if isinstance(v, bool):
        return str(int(v))
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            v = v.item()
        except (ValueError, AttributeError):
            pass
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == int(v) and abs(v) < 1e15:
            return str(int(v))
        return repr(round(v, 6))
    if isinstance(v, int):
        return str(v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def rows_of(pdf) -> list[tuple]:
    cols = sorted(pdf.columns)
    return sorted(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


def compare(spark, name: str, sf_dir: str, fn, sql: str | None, con=None) -> dict:
    sdf = fn(spark, sf_dir).toPandas()
    out = {"name": name, "spark_rows": len(sdf), "columns": sorted(sdf.columns)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    ddf = con.sql(sql).df()
    out["oracle_rows"] = len(ddf)
    if sorted(ddf.columns) != sorted(sdf.columns):
        out["status"] = f"columns differ: spark={sorted(sdf.columns)} oracle={sorted(ddf.columns)}"
        return out
    a, b = rows_of(sdf), rows_of(ddf)
    if len(a) != len(b):
        out["status"] = "row count differs"
    elif a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["status"] = f"values differ, e.g. {diff}"
    else:
        out["status"] = "match"
    return out


if __name__ == "__main__":
    import argparse
    import time

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    import __spark_entry__ as E
    from staffrank.session import build_session

    spark = build_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(args.sf)
    bad = 0
    for name in sorted(qs):
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        t = time.time()
        try:
            r = compare(spark, name, args.sf, qs[name], sqls.get(name), con)
        except Exception as exc:  # noqa: BLE001
            r = {"name": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        ok = r["status"] in ("match", "rows-only")
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:40s} {r.get('spark_rows')!s:>7} "
              f"{r.get('oracle_rows', '-')!s:>7} {time.time() - t:6.1f}s {r['status'][:300]}",
              flush=True)
    print("bad:", bad)
