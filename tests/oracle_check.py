"""Compare registered queries with their SQL on the same tables.

``python tests/oracle_check.py [sf_dir] [name prefix ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, bool | str):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, list | tuple):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(con, df, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    mine = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    for a, b in zip(mine, theirs, strict=True):
        if a != b:
            return f"{a!r:.900} != {b!r:.900}"
    return None


def main(sf_dir: str, prefixes: list[str]) -> int:
    import __spark_entry__ as entry
    from pollwright.session import local_session

    spark = local_session()
    con = connect(sf_dir)
    oracles, failed = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                problem = compare(con, df, oracles[name])
            else:
                problem = None if df.count() else "no rows"
            n = "" if name in oracles else " (rows only)"
        except Exception as error:  # noqa: BLE001
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name}{n} {time.time() - start:.2f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, sys.argv[2:]) else 0)
