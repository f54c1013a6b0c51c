"""Run registered queries against the DuckDB oracle and compare results.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer, float, np.floating, decimal.Decimal)):
        f = float(v)
        return None if math.isnan(f) else round(f, 6)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).tz_localize(None).isoformat() if pd.Timestamp(v).tzinfo else pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    return str(v)


def _rows(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    return sorted(
        (tuple(_norm(v) for v in row) for row in df[cols].itertuples(index=False, name=None)),
        key=repr,
    )


def compare(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> tuple[bool, str]:
    sc, oc = sorted(spark_df.columns), sorted(oracle_df.columns)
    if sc != oc:
        return False, f"columns differ: spark-only={set(sc)-set(oc)} oracle-only={set(oc)-set(sc)}"
    if len(spark_df) != len(oracle_df):
        return False, f"row count {len(spark_df)} vs {len(oracle_df)}"
    a, b = _rows(spark_df), _rows(oracle_df)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:2]
        detail = []
        for x, y in diffs:
            detail.append({sc[i]: (x[i], y[i]) for i in range(len(sc)) if x[i] != y[i]})
        return False, f"values differ: {detail}"
    return True, "ok"


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from __spark_entry__ import oracle_sql, queries

    from tripmart.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    failures = 0
    for key in keys or list(qs):
        t0 = time.time()
        try:
            sdf = qs[key](spark, sf_dir).toPandas()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {key}: spark error {str(exc)[:400]}")
            failures += 1
            continue
        t1 = time.time()
        if key not in sqls:
            print(f"ROWS {key}: {len(sdf)} rows (no oracle) {t1-t0:.1f}s")
            continue
        try:
            odf = con.sql(sqls[key]).df()
        except Exception as exc:  # noqa: BLE001
            print(f"FAIL {key}: oracle error {str(exc)[:600]}")
            failures += 1
            continue
        ok, msg = compare(sdf, odf)
        failures += not ok
        print(f"{'PASS' if ok else 'FAIL'} {key}: {len(sdf)} rows spark {t1-t0:.1f}s; {msg[:1500]}")
    print(f"failures: {failures}")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
