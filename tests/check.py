"""Compare registered queries with DuckDB on one folder of tables.

    python tests/check.py [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import datetime
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value):
    if isinstance(value, datetime):
        return value.isoformat()
    return str(value) if value is not None else None


def as_bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs: column names, or up to three rows of each side."""
    result = con.execute(sql)
    expected_columns = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(expected_columns):
        return [f"columns {sorted(df.columns)} != {sorted(expected_columns)}"]
    expected = as_bag(expected_columns, result.fetchall())
    found = as_bag(df.columns, df.collect())
    lines = [f"only in Spark: {row} x{n}" for row, n in list((found - expected).items())[:3]]
    return lines + [f"only in DuckDB: {row} x{n}" for row, n in list((expected - found).items())[:3]]


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from odsflow.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = build_session("check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names:
        started = time.time()
        try:
            lines = differences(queries()[name](spark, folder), con, oracle_sql()[name])
        except Exception as error:  # report and go on
            lines = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(lines)
        print(f"{'BAD ' if lines else 'ok  '} {name} {time.time() - started:.2f}s", *lines, sep="\n    " if lines else " ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
