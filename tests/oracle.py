"""Compare registered queries with their SQL on DuckDB, row by row."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _plain(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan") if math.isnan(value) else (1, f"{round(value, 6) + 0.0:.6f}")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, int):
        return (1, str(value))
    if isinstance(value, datetime.datetime):
        return (1, value.isoformat())
    return (1, str(value))


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def expected(name: str, sf: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    cursor = con.execute(registry.oracle_sql()[name])
    return _table([d[0] for d in cursor.description], cursor.fetchall())


def actual(spark, name: str, sf: str):
    df = registry.queries()[name](spark, sf)
    return _table(df.columns, [tuple(r) for r in df.collect()])


def compare(spark, name: str, sf: str) -> str | None:
    """None when equal, else a short account of the difference."""
    want_columns, want = expected(name, sf)
    got_columns, got = actual(spark, name, sf)
    if want_columns != got_columns:
        return f"columns {got_columns} expected {want_columns}"
    if want != got:
        missing, extra = sorted(set(want) - set(got)), sorted(set(got) - set(want))
        return (f"{len(got)} rows expected {len(want)}; missing {[tuple(v for _, v in r) for r in missing[:2]]} "
                f"extra {[tuple(v for _, v in r) for r in extra[:2]]}")
    return None if want else "no rows"


if __name__ == "__main__":
    from voxstar.session import build_session

    folder = sys.argv[1]
    session = build_session("local[8]", shuffle_partitions=8, spark__driver__memory="8g")
    failed = 0
    for query in sys.argv[2:] or registry.oracle_sql():
        begin = time.time()
        try:
            verdict = compare(session, query, folder)
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        failed += verdict is not None
        print(f"{time.time() - begin:6.1f}s {query}: {verdict or 'ok'}", flush=True)
    print("failed:", failed)
