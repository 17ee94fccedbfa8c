"""Run registered queries on Spark and their SQL on DuckDB, and compare rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value)
        return str(value)

    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark, connection, sf_dir, query, sql):
    """None when both sides agree, otherwise a short description."""
    frame = query(spark, sf_dir)
    left = _rows(frame.columns, frame.collect())
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    right = _rows(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{sorted(names)}: {a} against {b}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from hardwood.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = local_session("8")
    database = connect(folder)
    checks = entry.oracle_sql()
    for name, run in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            found = difference(session, database, folder, run, checks[name])
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found = f"failed: {str(error)[:600]}"
        print(f"{name:32s} {time.time() - start:6.2f}s {found or 'ok'}", flush=True)
