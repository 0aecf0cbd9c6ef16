"""Compare each registered query with its oracle: ``python -m workload.compare [folder] [key ...]``.

Rows are compared as multisets of values under sorted column names, doubles to the last bit.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from workload.inputs import TABLES
from workload.oracle import all_oracles
from workload.queries import all_queries


def local_session(cores: str = "8", partitions: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, bool) or value is None:
        return repr(value)
    return (type(value).__name__, repr(value))


def as_bag(columns, rows) -> Counter:
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in places) for row in rows)


def difference(spark, connection, folder: str, key: str) -> str | None:
    """What differs for ``key``, or None when both sides hold the same rows."""
    mine = all_queries()[key](spark, folder)
    rows = mine.collect()
    theirs = connection.sql(all_oracles()[key])
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} against {sorted(theirs.columns)}"
    left, right = as_bag(mine.columns, rows), as_bag(theirs.columns, theirs.fetchall())
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (
        f"{sum(left.values())} rows against {sum(right.values())}; "
        f"{sum(only_left.values())} only here, e.g. {sorted(only_left, key=str)[:2]}; "
        f"{sum(only_right.values())} only there, e.g. {sorted(only_right, key=str)[:2]}"
    )


def main(folder: str, keys: list[str]) -> int:
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(folder)
    failed = 0
    for key in keys or list(all_queries()):
        started = time.time()
        try:
            found = difference(spark, connection, folder, key)
        except Exception as error:  # report and go on with the next key
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += found is not None
        print(f"{'FAIL' if found else 'ok  '} {key} {time.time() - started:.1f}s {found or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:]
    where = arguments[0] if arguments else "/root/testdata/sf0.001"
    sys.exit(1 if main(where, arguments[1:]) else 0)
