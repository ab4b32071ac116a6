"""Run registered queries in Spark and their SQL oracles in DuckDB, and
compare row count, column names and order-insensitive rounded values.

Usage: python -m tests.oracle_harness [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 5)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (pd.Timestamp,)):
        return str(v)
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(name, spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return False, f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"rows {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = canon(spark_pdf), canon(duck_pdf)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return False, f"row {i}: spark={x} duck={y}"
    return True, "ok"


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    sys.path.insert(0, ".")
    import __spark_entry__ as ent
    from sparkexp.session import get_spark

    spark = get_spark()
    qs, sqls = ent.queries(), ent.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t = time.time()
        try:
            sp = fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t
        if name not in sqls:
            print(f"ROWS {name}: {len(sp)} rows ({dt:.1f}s)")
            continue
        try:
            dk = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        ok, msg = compare(name, sp, dk)
        bad += 0 if ok else 1
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {len(sp)} rows ({dt:.1f}s) {msg}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
