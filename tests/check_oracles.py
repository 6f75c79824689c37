"""Run catalog queries and their SQL counterparts side by side and report differences.

    python tests/check_oracles.py /root/testdata/sf0.01 [query …]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def kind(value):
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, (dt.datetime, dt.date)):
        return type(value).__name__
    return type(value).__name__


def canonical(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else f"{value + 0.0:.9g}"
    return "null" if value is None else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(canonical(r[i]) for i in order) for r in rows), [
        {kind(r[i]) for r in rows if r[i] is not None} for i in order
    ]


def compare(df, con, sql) -> str:
    """Empty text when both sides agree on names, value kinds and the multiset of rows."""
    left = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    right = table([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns differ: {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"row counts differ: {len(left[1])} / {len(right[1])}"
    kinds = [(n, a, b) for n, a, b in zip(left[0], left[2], right[2]) if a != b]
    if kinds:
        return f"value kinds differ: {kinds}"
    bad = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return f"{len(bad)} rows differ, first: {bad[0]}" if bad else ""


def main() -> int:
    from ledgerloom.catalog import QUERIES
    from ledgerloom.oracles import ORACLES
    from ledgerloom.session import build_session

    folder, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                problem = compare(df, con, ORACLES[name])
                note = f"{df.count()} rows"
            else:
                problem, note = "", f"rows only: {len(df.collect())}"
        except Exception as error:  # report and go on with the next query
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {note} {problem}",
              flush=True)
    print(f"{failed} failed of {len(names)}; without SQL: {sorted(set(QUERIES) - set(ORACLES))}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
