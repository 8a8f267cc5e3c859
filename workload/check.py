"""Runs registered queries on Spark and DuckDB and compares the results.

    python -m workload.check [--sf-dir DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time

import duckdb
from pyspark.sql import SparkSession

from workload.oracle import ORACLE
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cores: str = "8", partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fieldrank")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(_plain(v) for v in row) for row in df.select(*names).collect()]
    return names, sorted(rows, key=_key)


def sql_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    found = [column[0] for column in cursor.description]
    names = sorted(found)
    spots = [found.index(name) for name in names]
    rows = [tuple(_plain(row[i]) for i in spots) for row in cursor.fetchall()]
    return names, sorted(rows, key=_key)


def difference(ours, theirs) -> str | None:
    """What differs first, or None; values are compared exactly."""
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    pairs = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    if pairs:
        return f"{len(pairs)} rows differ, first {pairs[0][0]} / {pairs[0][1]}"
    kinds = [tuple(map(type, row)) for row in (ours[1][:1] + theirs[1][:1])]
    if len(set(kinds)) > 1 and None not in ours[1][0] + theirs[1][0]:
        return f"types {kinds}"
    return None


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    spark, connection = session(), database(options.sf_dir)
    failed = 0
    for name in options.names or QUERIES:
        start = time.perf_counter()
        try:
            ours = spark_rows(QUERIES[name](spark, options.sf_dir))
            taken = time.perf_counter() - start
            problem = difference(ours, sql_rows(connection, ORACLE[name]))
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            taken, problem, ours = time.perf_counter() - start, repr(error)[:1500], ((), ())
        failed += problem is not None
        print(f"{name:28} {len(ours[1]):7} rows {taken:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
