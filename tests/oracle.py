"""Run registered queries against their SQL in an in-process, in-memory DuckDB.

``python tests/oracle.py [sf] [query...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect(config={"memory_limit": "8GB"})
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(x):
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, float) and math.isnan(x):
        return "nan"
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    return x


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder: str, query, sql: str | None) -> str:
    """Empty string when both give the same rows, else what differs."""
    df = query(spark, folder)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "" if got else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = _rows(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}"
    types = [(a, b) for a, b in zip(got[:1], want[:1]) if [type(x) for x in a] != [type(x) for x in b]]
    return f"types differ {types}" if types else ""


if __name__ == "__main__":
    import __spark_entry__ as e
    from lakeloom import build_session

    sf, *names = sys.argv[1:] or ["0.01"]
    where = f"/root/testdata/sf{sf}"
    session = build_session("oracle", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    db = connect(where)
    failed = 0
    for name, query in e.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(session, db, where, query, e.oracle_sql().get(name))
        except Exception as ex:  # noqa: BLE001 - report and go on
            problem = f"{type(ex).__name__}: {str(ex)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s"
              f"{'' if name in e.oracle_sql() else ' (rows only)'} {problem[:900]}", flush=True)
    print("failed", failed)
