import os

import pytest

from fieldrank.llm.oracle import ORACLE
from fieldrank.llm.queries import QUERIES
from workload.check import database, difference, spark_rows, sql_rows

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    ours = spark_rows(QUERIES[name](spark, SF_DIR))
    assert difference(ours, sql_rows(database(SF_DIR), ORACLE[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_one_query_per_operator():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
