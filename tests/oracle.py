"""Compare every registered query with its SQL: ``python tests/oracle.py [sf_dir] [query ...]``."""

from __future__ import annotations

import datetime
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).parent.parent))

import __spark_entry__ as entry  # noqa: E402

# DuckDB and Spark names of the same type.
SAME_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in entry.TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _comparable(value):
    if isinstance(value, datetime.datetime) and value.tzinfo:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_comparable(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Why the two results differ; empty when they are the same, values compared exactly."""
    cursor = con.execute(sql)
    expected_types = {d[0]: SAME_TYPE.get(str(d[1]), str(d[1])) for d in cursor.description}
    expected_names = [d[0] for d in cursor.description]
    expected = _rows(expected_names, cursor.fetchall())
    types = dict(df.dtypes)
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if types != expected_types:
        problems.append(f"types {types} != {expected_types}")
    if len(found) != len(expected):
        problems.append(f"{len(found)} rows != {len(expected)}")
    wrong = [(a, b) for a, b in zip(found, expected) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[0]}")
    return problems


def main() -> int:
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = set(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if name not in sql or (chosen and name not in chosen):
            continue
        start = time.time()
        try:
            problems = differences(query(spark, sf_dir), con, sql[name])
        except Exception as problem:
            problems = [f"{type(problem).__name__}: {str(problem)[:600]}"]
        bad += bool(problems)
        print(f"{'ok ' if not problems else 'BAD'} {name} {time.time() - start:.1f}s {' | '.join(problems)}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
