"""Run registered queries in Spark and their SQL in DuckDB, compare like the driver.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compare = row count, sorted column names, order-insensitive hash of values
(floats rounded to 6 places).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def canon(df: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    rows = [tuple(repr(_norm(r[c])) for c in cols) for _, r in df.iterrows()]
    return cols, sorted(rows)


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict[str, str]:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(qs):
        if name not in sqls:
            out[name] = "no-oracle"
            continue
        t0 = time.time()
        try:
            s = qs[name](spark, sf_dir).toPandas()
            d = con.execute(sqls[name]).df()
        except Exception as e:  # report and continue
            out[name] = f"ERROR {type(e).__name__}: {str(e)[:400]}"
            if verbose:
                print(name, out[name], flush=True)
            continue
        sc, sr = canon(s)
        dc, dr = canon(d)
        if sc != dc:
            res = f"COLUMNS spark={sc} duck={dc}"
        elif len(sr) != len(dr):
            res = f"ROWS spark={len(sr)} duck={len(dr)}"
        elif sr != dr:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
            res = f"VALUES {diff}"
        else:
            res = f"OK rows={len(sr)}"
        out[name] = res
        if verbose:
            print(f"{name}: {res} ({time.time() - t0:.1f}s)", flush=True)
    return out


if __name__ == "__main__":
    from prismark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if not (v.startswith("OK") or v == "no-oracle")}
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {sorted(bad)}")
