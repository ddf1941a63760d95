"""Compare registered queries with their SQL on DuckDB: ``python tests/oracle.py [sf] [name ...]``."""
from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


# What each side calls the same type.
SAME = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def _plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (bool, str, int)):
        return value
    if isinstance(value, float):
        return round(value, 6)
    return str(value)


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, con, sf: str, fn, sql: str) -> str | None:
    """None when both sides hold the same rows, else a short description."""
    frame = fn(spark, sf)
    names, mine = rows_of(frame.columns, frame.collect())
    cursor = con.execute(sql)
    wanted, theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if names != wanted:
        return f"columns {names} != {wanted}"
    kinds = {d[0]: SAME.get(str(d[1]), str(d[1])) for d in con.execute(sql).description}
    other = {n: (t, kinds[n]) for n, t in frame.dtypes if t != kinds[n]}
    if other:
        return f"types {other}"
    if mine != theirs:
        extra, missing = mine - theirs, theirs - mine
        return (
            f"{sum(mine.values())} rows against {sum(theirs.values())}; "
            f"extra {list(extra.items())[:2]}; missing {list(missing.items())[:2]}"
        )
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from conftest import make_session

    sf = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    spark, con = make_session(), connect(sf)
    sqls, failed = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        began = time.time()
        try:
            found = difference(spark, con, sf, fn, sqls[name]) if name in sqls else "no SQL"
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:400]}"
        failed += found is not None
        print(f"{name:24} {time.time() - began:6.2f}s  {found or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
