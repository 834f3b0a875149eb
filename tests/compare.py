"""Run queries against the oracle and compare the row multisets.

python tests/compare.py <sf dir> [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def multiset(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir: str, name: str, function, sql: str):
    """(rows, problem or None)."""
    frame = function(spark, sf_dir)
    got = multiset(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = multiset(names, result.fetchall())
    rows = sum(got.values())
    if sorted(frame.columns) != sorted(names):
        return rows, f"columns {sorted(frame.columns)} != {sorted(names)}"
    if got != expected:
        extra, lost = got - expected, expected - got
        return rows, f"{sum(extra.values())} extra {list(extra)[:3]}, {sum(lost.values())} lost {list(lost)[:3]}"
    return rows, None


if __name__ == "__main__":
    import os

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
    import __spark_entry__ as entry
    from lanewise.session import build_session

    session = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    folder, chosen = sys.argv[1], sys.argv[2:]
    oracle = oracle_connection(folder)
    sqls = entry.oracle_sql()
    for key, run in entry.queries().items():
        if chosen and key not in chosen:
            continue
        start = time.time()
        try:
            count, problem = compare(session, oracle, folder, key, run, sqls[key])
        except Exception as error:  # noqa: BLE001
            count, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok ' if problem is None else 'BAD'} {key:32s} {count:8d} {time.time() - start:6.2f}s {problem or ''}", flush=True)
