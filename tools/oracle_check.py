"""Compare each registered Spark query with its DuckDB oracle.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
Prints one line per query: ok / MISMATCH with row counts and a sample diff.
"""

from __future__ import annotations

import math
import sys
from collections import Counter

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(__file__)))

import duckdb  # noqa: E402

from skein.fixtures import BASE_TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v) if not isinstance(v, str) else v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


def duck_conn(sf_dir):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, name, sf_dir, con=None, verbose=True):
    from skein.plans.catalog import ORACLE, QUERIES
    df = QUERIES[name](spark, sf_dir)
    s_cols = df.columns
    if len(set(s_cols)) != len(s_cols):  # such a result can't be saved
        return ("COLUMNS", s_cols, "repeated")
    s_rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        return ("rows-only", len(s_rows), None)
    con = con or duck_conn(sf_dir)
    res = con.execute(ORACLE[name])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return ("COLUMNS", s_cols, d_cols)
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a == b:
        return ("ok", len(s_rows), len(d_rows))
    only_s = list((a - b).elements())[:3]
    only_d = list((b - a).elements())[:3]
    return ("MISMATCH", len(s_rows), len(d_rows), only_s, only_d)


def main():
    from skein.session import get_spark
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    from skein.plans.catalog import QUERIES
    con = duck_conn(sf_dir)
    bad = 0
    for n in (names or list(QUERIES)):
        try:
            r = check(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = ("ERROR", repr(e)[:600])
        if r[0] not in ("ok", "rows-only"):
            bad += 1
        print(n, *r, flush=True)
    print("bad", bad)


if __name__ == "__main__":
    main()
