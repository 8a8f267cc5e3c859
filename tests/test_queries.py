import json
import os
import re
import subprocess
import sys

import pytest

import __spark_entry__ as entry_points
from workload.check import database, difference, spark_rows, sql_rows
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry_points.queries()) >= set(QUERIES)
    assert set(entry_points.queries()) >= set(entry_points.oracle_sql()) >= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    ours = spark_rows(QUERIES[name](spark, SF_DIR))
    assert difference(ours, sql_rows(connection, ORACLE[name])) is None


def test_entry_gives_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_bench_prints_one_json_line():
    env = os.environ | {
        "BENCH_SF_DIR": SF_DIR, "BENCH_CPUS": "2", "BENCH_RUNS": "1", "BENCH_QUERIES": "top_n",
    }
    done = subprocess.run(
        [sys.executable, "bench.py"], env=env, capture_output=True, text=True, timeout=300,
        cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
    )
    lines = [line for line in done.stdout.splitlines() if re.match(r"\{", line)]
    assert len(lines) == 1
    assert {"metric", "value", "unit", "queries", "sf"} <= set(json.loads(lines[0]))
