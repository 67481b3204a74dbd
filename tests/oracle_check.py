"""Compare registered queries with their SQL: ``python tests/oracle_check.py sf_dir [key ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted; every value by its exact text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value) -> str:
        if isinstance(value, float) and not math.isnan(value):
            return repr(value + 0.0)
        return repr(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def differences(spark, con, sf_dir: str, key: str) -> list[str]:
    df = entry_module.queries()[key](spark, sf_dir)
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(entry_module.oracle_sql()[key])
    names = [d[0] for d in result.description]
    theirs = canonical(names, result.fetchall())
    found = []
    if sorted(df.columns) != sorted(names):
        found.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if len(mine) != len(theirs):
        found.append(f"rows {len(mine)} != {len(theirs)}")
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first: {wrong[0]}")
    return found


def main() -> int:
    from tests.conftest import new_session

    sf_dir, *keys = sys.argv[1:]
    spark, con = new_session(), connect(sf_dir)
    bad = 0
    for key in keys or entry_module.oracle_sql():
        t0 = time.time()
        try:
            found = differences(spark, con, sf_dir, key)
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok'} {key} {time.time() - t0:.2f}s", *found, flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
