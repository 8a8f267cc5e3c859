"""Snapshot tables placed by entity: windows over an entity's history need no shuffle.

A table by date is right for loads and for work on one snapshot. One that is read along
entities again and again is better placed by Spark's own buckets: an entity's rows lie
in one bucket, sorted, and Parquet bloom filters on the id let look-ups of single
entities skip row groups. It is partitioned by month as well, so a load rewrites the
months that it touches and nothing else.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldrank.materialise import materialise
from fieldrank.roles import DEFAULT_ROLES, Roles

PERIOD = "period"


def _period(roles: Roles) -> Column:
    return F.date_format(roles.snapshot_date, "yyyy-MM")


def place_by_entity(
    df: DataFrame, table: str, path: str, buckets: int, roles: Roles = DEFAULT_ROLES
) -> None:
    """Write ``df`` as ``table`` below ``path``, in ``buckets`` by entity and by month.

    Choose buckets so that one holds what a task can sort; they stay as they are until
    the table is placed anew. Input is unique by entity and date.
    """
    entity, day = roles.entity_id, roles.snapshot_date
    (
        # Hashed as the buckets are, so a bucket of a month is one file.
        df.withColumn(PERIOD, _period(roles)).repartition(buckets, entity)
        .write.mode("overwrite").partitionBy(PERIOD).bucketBy(buckets, entity).sortBy(entity, day)
        .option("path", path)
        .option(f"parquet.bloom.filter.enabled#{entity}", "true")
        .saveAsTable(table)
    )


def read_placed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(PERIOD)


def refresh_placed(
    cleaned: DataFrame, table: str, changed: list[dt.date], roles: Roles = DEFAULT_ROLES
) -> None:
    """Bring the months of new or reloaded dates up to date with ``cleaned``.

    ``cleaned`` is the table by date: its partitions of those months are read, the others
    are not touched. A month that has no rows any more stays as it is.
    """
    if not changed:
        return
    spark, entity, day = cleaned.sparkSession, roles.entity_id, roles.snapshot_date
    months = sorted({date.replace(day=1) for date in changed})
    spans = [
        F.col(day).between(F.lit(month), F.last_day(F.lit(month))) for month in months
    ]
    wanted = spans[0]
    for span in spans[1:]:
        wanted |= span
    columns = read_placed(spark, table).columns
    fresh = materialise(
        cleaned.where(wanted).select(*columns, _period(roles).alias(PERIOD)),
        periods=F.collect_set(PERIOD),
    )
    buckets = _buckets(spark, table)
    for period in sorted(fresh.observed["periods"] or []):
        # Named, so this partition alone is replaced, whatever the session's mode.
        rows = fresh.df.where(F.col(PERIOD) == period).select(*columns).repartition(buckets, entity)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({PERIOD} = '{period}') SELECT * FROM {{rows}}", rows=rows)


def _buckets(spark: SparkSession, table: str) -> int:
    told = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'")
    return int(told.first().data_type)
