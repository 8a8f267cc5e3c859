import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SNAPSHOT = (
    "entity_id string, entity_name string, group_name string, snapshot_date date, "
    "quality double, speed double, price_in double, price_out double"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def snapshot_rows(spark):
    """Builds snapshot rows from (id, day, quality, speed, price_in, price_out)."""
    def build(*rows):
        full = [
            (key, f"name {key}", "group", day_of(day), *map(_double, values))
            for key, day, *values in rows
        ]
        return spark.createDataFrame(full, SNAPSHOT)

    return build


def _double(value):
    return None if value is None else float(value)


def day_of(number: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=number - 1)


def as_dicts(df, *order):
    return [row.asDict() for row in df.orderBy(*order).collect()]


def as_set(df):
    names = sorted(df.columns)
    return sorted(repr(tuple(row[name] for name in names)) for row in df.collect())
