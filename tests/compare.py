"""Run queries beside their SQL and compare row count, columns and values.

``python -m tests.compare [folder] [name ...]``; ``COMPARE_PARTITIONS`` sets the shuffle
partitions, and with them the number of chunks.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from skylattice.plans import Tables, oracle, registry


def normal(value):
    if value is None:
        return None
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return bool(value)
    if isinstance(value, float) or hasattr(value, "dtype"):
        value = float(value)
        return None if math.isnan(value) else float(f"{value:.12g}") + 0.0
    if isinstance(value, int):
        return float(value)
    return str(value)


def key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def sql_rows(folder: str, sql: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in Tables.NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    got = con.execute(sql)
    return [d[0] for d in got.description], got.fetchall()


def differences(df, folder: str, sql: str) -> str | None:
    """What is different, or None."""
    rows = [tuple(r) for r in df.collect()]
    columns, expected = sql_rows(folder, sql)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows against {len(expected)}"
    names = sorted(columns)
    mine = sorted((tuple(normal(r[df.columns.index(n)]) for n in names) for r in rows), key=key)
    theirs = sorted((tuple(normal(r[columns.index(n)]) for n in names) for r in expected), key=key)
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(rows)} rows differ, {names}: {bad[:3]}"
    return None


def main() -> int:
    from skylattice.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("compare", "8", int(os.environ.get("COMPARE_PARTITIONS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    texts = oracle()
    failed = 0
    for name, run in registry().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in texts:
                problem = differences(df, folder, texts[name])
            else:
                problem = None if df.collect() else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        state = "ok  " if problem is None else "FAIL"
        print(f"{state} {name:24s} {time.time() - start:6.1f}s {'' if name in texts else '(rows only)'} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
