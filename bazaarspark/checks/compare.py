"""Run registered queries next to their SQL: python -m bazaarspark.checks.compare FOLDER [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

from bazaarspark.checks.registry import checks
from bazaarspark.session import session


def tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10]
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, check, folder: str) -> str | None:
    """None when the two results agree, else what differs."""
    df = check.run(spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if check.sql is None:
        return None if mine else "no rows"
    cursor = con.execute(check.oracle())
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {df.columns} / {names}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows, SQL {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        a, b = bad[0]
        cols = sorted(df.columns)
        cells = [(cols[i], a[i], b[i]) for i in range(len(a)) if a[i] != b[i]]
        return f"{len(bad)} of {len(mine)} rows differ, e.g. {cells[:6]}"
    return None


def main() -> int:
    folder, *names = sys.argv[1:]
    spark, con, failed = session("compare"), tables(folder), 0
    for name, check in checks().items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            problem = difference(spark, con, check, folder)
        except Exception as e:  # noqa: BLE001 - report every query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
