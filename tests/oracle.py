"""Compares a query with its SQL: python tests/oracle.py [--sf DIR] NAME..."""

from __future__ import annotations

import glob
import os
import sys
from decimal import Decimal

import duckdb
import pandas as pd
from pandas.testing import assert_frame_equal

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if glob.glob(path):
            con.execute(f"create view {name} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows by value; numbers as floats with nulls as NaN, all else as text."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        numbers = pd.api.types.is_numeric_dtype(column) and not pd.api.types.is_bool_dtype(column)
        if numbers or (column.notna().any() and column.dropna().map(lambda v: isinstance(v, int | float | Decimal) and not isinstance(v, bool)).all()):
            frame[name] = pd.to_numeric(column, errors="coerce").astype("float64").round(6)
        else:
            frame[name] = column.astype(object).where(column.notna(), None).map(lambda v: v if v is None else str(v))
    return frame.sort_values(list(frame.columns), key=lambda c: c.astype(str)).reset_index(drop=True)


def compare(name: str, spark, con, sf_dir: str) -> int:
    """Fails on any difference; returns the number of rows."""
    import __spark_entry__ as e

    got = canonical(e.queries()[name](spark, sf_dir).toPandas())
    want = canonical(con.execute(e.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns), (name, list(got.columns), list(want.columns))
    assert len(got) == len(want), (name, len(got), len(want))
    assert_frame_equal(got, want, check_dtype=False, check_exact=False, rtol=1e-9, atol=1e-9, obj=name)
    return len(got)


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import time

    import __spark_entry__ as e
    from scriptorium.session import session

    args = sys.argv[1:]
    sf = args.pop(1) if args[:1] == ["--sf"] else "/root/testdata/sf0.01"
    args = [a for a in args if a != "--sf"]
    spark = session(master=f"local[{os.environ.get('CPUS', '4')}]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in args or sorted(set(e.oracle_sql())):
        began = time.time()
        try:
            if name in e.oracle_sql():
                print("same", name, compare(name, spark, con, sf), f"{time.time() - began:.1f}s", flush=True)
            else:
                rows = e.queries()[name](spark, sf).toPandas()
                print("ran ", name, len(rows), f"{time.time() - began:.1f}s", rows.head(5).to_string(), sep="\n", flush=True)
        except Exception as error:
            print("DIFF", name, str(error)[:1500], flush=True)
