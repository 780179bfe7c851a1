"""Run registered queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
        return None
    if isinstance(v, (list, dict, tuple, np.ndarray)):
        return str(v)
    return v.item() if isinstance(v, np.generic) else v


def _rank(v):
    return (0, 0, "") if v is None else ((1, v, "") if isinstance(v, (int, float, bool)) else (2, 0, str(v)))


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as plain tuples, columns and rows in a fixed order."""
    columns = [df[c].tolist() for c in sorted(df.columns)]
    rows = [tuple(_plain(v) for v in row) for row in zip(*columns)]
    return sorted(rows, key=lambda row: tuple(_rank(v) for v in row))


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when equal."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} vs {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    kinds = [(c, got[c].dtype.kind, want[c].dtype.kind) for c in sorted(got.columns)
             if got[c].notna().all() and want[c].notna().all() and got[c].dtype.kind != want[c].dtype.kind]
    a, b = canonical(got), canonical(want)
    bad = [k for k, (x, y) in enumerate(zip(a, b)) if x != y]
    if bad:
        names = sorted(got.columns)
        x, y = a[bad[0]], b[bad[0]]
        return (f"{len(bad)} of {len(a)} rows differ, first "
                f"{[(n, p, q) for n, p, q in zip(names, x, y) if p != q]} at {x}")
    return f"types {kinds}" if kinds else ""


def main(argv):
    import __spark_entry__ as entry
    from seriesmill.session import build_session
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not argv or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in argv)]
    failed = 0
    for name in names:
        t0 = time.time()
        try:
            got = queries[name](spark, sf).toPandas()
            t1 = time.time()
            if name in oracles:
                want = con.execute(oracles[name]).fetchdf()
                diff = difference(got, want)
                kind = "OK" if not diff else "DIFF " + diff[:600]
            else:
                kind = "ROWS"
            if not len(got):
                kind += " (EMPTY)"
            print(f"{name}: {kind} rows={len(got)} spark={t1 - t0:.1f}s duck={time.time() - t1:.1f}s", flush=True)
            failed += kind.startswith("DIFF")
        except Exception as exc:  # noqa: BLE001
            failed += 1
            print(f"{name}: ERROR {str(exc)[:700]}", flush=True)
    print(f"{len(names)} run, {failed} failed", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
