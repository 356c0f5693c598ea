"""Run registered queries against their DuckDB oracles the way the driver does:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 4) + 0.0)
    return str(v)


def value_hash(pdf: pd.DataFrame) -> str:
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_cell(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()[:16]


def compare(spark, names=None, sf_dir="/root/testdata/sf0.01", verbose=True):
    import __spark_entry__ as E
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in (names or list(qs)):
        t = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name]) if verbose else None
            continue
        el = time.time() - t
        if name not in os_:
            results[name] = f"rows-only {len(sp)}"
            print(f"{name:32s} {results[name]} ({el:.1f}s)") if verbose else None
            continue
        try:
            dk = con.sql(os_[name]).df()
        except Exception as e:  # noqa: BLE001
            results[name] = f"SQL ERROR {str(e)[:300]}"
            print(name, results[name]) if verbose else None
            continue
        ok_cols = sorted(sp.columns) == sorted(dk.columns)
        ok_rows = len(sp) == len(dk)
        ok_hash = ok_cols and value_hash(sp) == value_hash(dk)
        results[name] = "OK" if (ok_cols and ok_rows and ok_hash) else (
            f"MISMATCH cols={ok_cols} rows={len(sp)}/{len(dk)} hash={ok_hash} "
            f"spark_cols={sorted(sp.columns)} sql_cols={sorted(dk.columns)}")
        if verbose:
            print(f"{name:32s} {results[name]} ({el:.1f}s)")
    return results


if __name__ == "__main__":
    from retentia.session import get_spark
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    names = sys.argv[1:] or None
    compare(spark, names)
