"""Local stand-in for the driver's check: Spark query vs DuckDB oracle.

Usage: python tests/compare_oracle.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of values.
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as E  # noqa: E402
from wardflow.session import get_session  # noqa: E402
from wardflow.sources.schemas import TABLES  # noqa: E402


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and v != v) else
                          (pd.Timestamp(v).isoformat() if hasattr(v, "isoformat") else
                           (list(v) if hasattr(v, "tolist") else v)))
    return df


def _hash(df: pd.DataFrame) -> str:
    rows = sorted(repr(tuple(r)) for r in df.itertuples(index=False))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()[:16]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session(driver_memory="8g")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for n in names or list(qs):
        t0 = time.time()
        try:
            s = qs[n](spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{n:32s} SPARK ERROR {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if n not in sql:
            print(f"{n:32s} rows={len(s)} (no oracle) {ts:.1f}s")
            continue
        try:
            o = con.execute(sql[n]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{n:32s} SQL ERROR {str(e)[:400]}")
            bad += 1
            continue
        same_cols = sorted(s.columns) == sorted(o.columns)
        if same_cols and os.environ.get("SHOW_TYPES"):
            diff = {c: (str(s[c].dtype), str(o[c].dtype)) for c in s.columns if str(s[c].dtype) != str(o[c].dtype)}
            if diff:
                print(f"  dtype differences in {n}: {diff}")
        hs, ho = (_hash(_norm(s)), _hash(_norm(o))) if same_cols else ("-", "-")
        ok = same_cols and len(s) == len(o) and hs == ho
        bad += not ok
        print(f"{n:32s} {'OK ' if ok else 'BAD'} rows={len(s)}/{len(o)} cols={'=' if same_cols else (sorted(s.columns), sorted(o.columns))} {ts:.1f}s")
        if not ok and same_cols and os.environ.get("SHOW_DIFF"):
            a, b = _norm(s), _norm(o)
            sa = set(map(lambda r: repr(tuple(r)), a.itertuples(index=False)))
            sb = set(map(lambda r: repr(tuple(r)), b.itertuples(index=False)))
            print("  spark-only:", list(sa - sb)[:3])
            print("  oracle-only:", list(sb - sa)[:3])
    print("FAILURES:", bad)


if __name__ == "__main__":
    main()
