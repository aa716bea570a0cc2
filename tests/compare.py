"""Spark against DuckDB on the same directory: python tests/compare.py SF NAME..."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    tidy = lambda v: str(round(v, 6)) if isinstance(v, float) else str(v)
    return [names[i] for i in order], sorted(tuple(tidy(r[i]) for i in order) for r in rows)


def duck(sf: str):
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def compare(spark, con, sf: str, name: str, f, sql: str | None) -> str:
    began = time.time()
    df = f(spark, sf)
    names, ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - began
    if sql is None:
        return f"{name}: {len(ours)} rows, {took:.1f} s, no SQL {ours[:2]}"
    res = con.execute(sql)
    columns, theirs = rows_of([x[0] for x in res.description], res.fetchall())
    if (names, ours) == (columns, theirs):
        return f"{name}: ok, {len(ours)} rows, {took:.1f} s"
    a, b = set(ours), set(theirs)
    return f"{name}: DIFFERS {names} {columns} {len(ours)} {len(theirs)} only here {len(a - b)} {sorted(a - b)[:3]} only SQL {len(b - a)} {sorted(b - a)[:3]}"


if __name__ == "__main__":
    import __spark_entry__ as e
    from taxaloom.session import local_session

    spark, sf = local_session(), sys.argv[1]
    con, q, sql = duck(sf), e.queries(), e.oracle_sql()
    for name in sys.argv[2:] or q:
        try:
            print(compare(spark, con, sf, name, q[name], sql.get(name)), flush=True)
        except Exception as x:  # noqa: BLE001
            print(f"{name}: FAILED {str(x)[:1500]}", flush=True)
