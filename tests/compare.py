"""Run registered queries beside their SQL and compare rows; also a command line tool."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def normal(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):
        return float(v)
    return v


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(normal(r[i]) for i in order) for r in data), key=lambda r: tuple((x is None, str(x)) for x in r)
    )


def compare(spark, con, sf, name, query, sql):
    """(ok, message, rows)"""
    df = query(spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return True, "rows only", len(got)
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    want = rows_of(cols, rel.fetchall())
    if sorted(cols) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} / {sorted(cols)}", len(got)
    if got == want:
        return True, "equal", len(got)
    diff = [(a, b) for a, b in zip(got, want) if a != b][:2]
    return False, f"rows {len(got)} / {len(want)}; first differences {str(diff)[:700]}", len(got)


if __name__ == "__main__":
    import __spark_entry__ as entry
    from riskloom.session import local_session

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark = local_session()
    con = connect(sf)
    sql = entry.oracle_sql()
    bad = []
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            ok, message, n = compare(spark, con, sf, name, query, sql.get(name))
        except Exception as e:
            ok, message, n = False, f"{type(e).__name__}: {str(e)[:900]}", 0
        print(f"{'ok ' if ok else 'BAD'} {name:36s} {time.time() - start:6.1f}s rows={n} {message}", flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)
