"""Run queries in Spark and their oracle SQL in DuckDB and compare all values.

``python tests/compare.py [folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return ("float", round(value, 9))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("date", value.isoformat())
    return (type(value).__name__, value)


def normalised(columns: list[str], rows: list) -> list:
    """Rows with columns in name order, sorted, NULL apart from everything else."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_cell(row[i]) for i in order]) for row in rows)


def differences(df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(df.columns)} against {sorted(names)}")
    ours = normalised(df.columns, [tuple(row) for row in df.collect()])
    theirs = normalised(names, result.fetchall())
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows against {len(theirs)}")
    if ours != theirs:
        only = sorted(set(ours) - set(theirs))[:2], sorted(set(theirs) - set(ours))[:2]
        problems.append(f"values differ, e.g. {only}")
    return problems


def main(folder: str, chosen: list[str]) -> int:
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as entry
    from pavilion.session import open_session

    spark = open_session("compare", "local[8]", spark__sql__shuffle__partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, failed = oracle_connection(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        df = query(spark, folder)
        problems = differences(df, connection, sql[name]) if name in sql else ["no oracle"]
        failed += bool(problems)
        print(f"{name:24} {time.time() - start:6.2f}s {'; '.join(problems) or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
