"""Date-partitioned Parquet tables that can be reloaded date by date."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldrank.contracts import ALLOWED_TYPES, check_contract, check_types
from fieldrank.materialise import observed_metrics
from fieldrank.names import named
from fieldrank.roles import DEFAULT_ROLES, Roles

DAY = DEFAULT_ROLES.snapshot_date

_AUDIT = (
    "load_id string, loaded_at timestamp, operation string, snapshot_date date, n_rows bigint"
)


@dataclass(frozen=True)
class Load:
    """What one write did; ``rejected`` counts what a landing load left out."""

    rows: int
    dates: list[dt.date] = field(default_factory=list)
    rejected: int = 0


def write_snapshots(
    df: DataFrame,
    root: str,
    day: str = DAY,
    contract: str | None = None,
    open_columns: bool = False,
    operation: str = "replace dates",
    arranged: bool = False,
    roles: Roles = DEFAULT_ROLES,
    load_id: str | None = None,
    more_types: tuple[str, ...] = (),
) -> Load:
    """Replace exactly the dates found in ``df``; create the table if needed.

    Executors write. Rows are brought together by date first, where AQE splits
    a large date over several tasks and packs small ones; ``arranged`` says
    they already lie by date and skips that shuffle. ``load_id`` names the load in
    the history: a load that comes again under its name is told once. ``more_types``
    are allowed besides the usual ones.

    No rows means nothing is touched; a row without a date is an error. A failed
    write may leave some dates replaced and others not; running it again settles
    that. ``df`` must not read ``root`` itself: write such a result somewhere
    first.
    """
    check_types(df, (*ALLOWED_TYPES, *more_types))
    if contract:
        check_contract(df, contract, open_columns, roles)
    seen = Observation()
    undated = F.raise_error(F.lit(f"row without {day}"))
    dated = df.withColumn(day, F.coalesce(F.col(day), undated.cast("date")))
    # Observed in the writing stage itself, where a repeated task counts once.
    (
        (dated if arranged else dated.hint("rebalance", day))
        .observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(day).alias("dates"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(root)
    )
    found = observed_metrics(seen)
    load = Load(found.get("rows") or 0, sorted(found.get("dates") or []))
    if load.rows:
        _record_audit(df.sparkSession, root, load, operation, day, load_id or new_load_id())
    return load


def _audit_root(root: str) -> str:
    return root.rstrip("/") + "_loads"


def new_load_id() -> str:
    # The prefix keeps Spark from reading a folder's name as a number.
    return f"load-{uuid.uuid4().hex}"


def overwrite_load(df: DataFrame, root: str, load_id: str) -> None:
    """Write the lines of one load, in place of those it wrote before."""
    (
        df.withColumn("load_id", F.lit(load_id)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(root)
    )


def _record_audit(
    spark: SparkSession, root: str, load: Load, operation: str, day: str, load_id: str
) -> None:
    # Counting a partition reads file footers only.
    lines = (
        read_dates(spark, root, load.dates, day)
        .groupBy(F.col(day).alias("snapshot_date"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumns({
            "loaded_at": F.lit(dt.datetime.now(dt.timezone.utc)),
            "operation": F.lit(operation),
        })
    )
    overwrite_load(lines, _audit_root(root), load_id)


def load_history(spark: SparkSession, root: str) -> DataFrame:
    """Every load of the table, numbered from 0: when, how, which dates with
    how many rows."""
    lines = spark.read.schema(_AUDIT).parquet(_audit_root(root))
    order = Window.orderBy("loaded_at", "load_id")  # over one row per load
    loads = lines.select("load_id", "loaded_at").distinct()
    versions = loads.select("load_id", (F.row_number().over(order) - 1).alias("version"))
    return lines.join(versions, "load_id")


def find_table(spark: SparkSession, root: str, day: str = DAY) -> DataFrame | None:
    """The table, or None while nothing has been written."""
    return read_snapshots(spark, root) if stored_dates(spark, root, day) else None


def stored_dates(spark: SparkSession, root: str, day: str = DAY) -> list[dt.date]:
    """The dates of the table in order, from one listing of its folder; no file
    is opened."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = (str(status.getPath().getName()) for status in files.listStatus(folder))
    found = (re.fullmatch(rf"{re.escape(day)}=(\d{{4}}-\d\d-\d\d)", name) for name in names)
    return sorted(dt.date.fromisoformat(match[1]) for match in found if match)


def read_latest(spark: SparkSession, root: str, day: str = DAY) -> DataFrame:
    """The newest snapshot of the table; only its folder is read.

    A missing table raises Spark's own path error.
    """
    dates = stored_dates(spark, root, day)
    return read_dates(spark, root, dates[-1:], day) if dates else read_snapshots(spark, root)


def read_snapshots(
    spark: SparkSession,
    root: str,
    since: dt.date | str | None = None,
    until: dt.date | str | None = None,
    merge_schema: bool = False,
    day: str = DAY,
) -> DataFrame:
    """The table, or a span of its dates (only those folders are read).

    ``merge_schema`` unites the columns of all loads; older rows get null. A
    missing table raises Spark's own path error.
    """
    df = spark.read.option("mergeSchema", merge_schema).parquet(root)
    if since is not None:
        df = df.where(F.col(day) >= F.lit(since).cast("date"))
    if until is not None:
        df = df.where(F.col(day) <= F.lit(until).cast("date"))
    return df


def read_dates(
    spark: SparkSession,
    root: str,
    dates: list[dt.date],
    day: str = DAY,
    merge_schema: bool = False,
) -> DataFrame:
    """Those of the named dates that the table has.

    Only their folders are listed and only their files asked for columns,
    however many dates there are. None of them there is an error.
    """
    there = sorted(set(stored_dates(spark, root, day)) & set(dates))
    if not there:
        raise FileNotFoundError(f"{root} has none of the wanted dates")
    reader = spark.read.option("basePath", root).option("mergeSchema", merge_schema)
    return reader.parquet(*(f"{_literal(root.rstrip('/'))}/{day}={date}" for date in there))


def _literal(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def find_dates(
    spark: SparkSession, root: str, dates: list[dt.date], merge_schema: bool = False
) -> DataFrame | None:
    """As :func:`read_dates`, or None if the table has none of the dates."""
    if not set(stored_dates(spark, root)) & set(dates):
        return None
    return read_dates(spark, root, dates, merge_schema=merge_schema)


def merged(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Both frames under the union of their columns."""
    return older.unionByName(newer, allowMissingColumns=True)


def table_summary(df: DataFrame, day: str = DAY) -> DataFrame:
    """Rows and snapshots of the whole table."""
    return df.groupBy(day).count().agg(
        F.sum("count").alias("n_rows"), F.count(day).alias("n_snapshots")
    )


def table_health(df: DataFrame, columns: list[str], day: str = DAY) -> DataFrame:
    """Per snapshot: rows, and nulls, lowest and highest of each column."""
    parts = [F.count(F.lit(1)).alias("n_rows")]
    for name in columns:
        parts += [
            F.count_if(named(name).isNull()).alias(f"{name}_nulls"),
            F.min(named(name)).alias(f"{name}_lo"),
            F.max(named(name)).alias(f"{name}_hi"),
        ]
    return df.groupBy(day).agg(*parts)
