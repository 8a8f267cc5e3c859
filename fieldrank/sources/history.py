"""Correction history: which values a table held for a date, load by load.

Every row carries the load that brought it (``known_from``) and the load that
replaced or dropped it (``known_until``, null while it holds). A load closes what it
changes and opens what is new; what it repeats stays as it is. Only partitions with
a change are written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldrank.materialise import materialise
from fieldrank.names import named
from fieldrank.sources.store import read_dates, read_snapshots, stored_dates

FROM, UNTIL = "known_from", "known_until"


def record_load(
    spark: SparkSession, root: str, rows: DataFrame, load: int, key: list[str], day: str = "snapshot_date"
) -> int:
    """Enter a load that holds whole dates; the number of rows it opened or closed.

    ``key`` is unique within a date and not null. The same load again changes
    nothing, also after it failed halfway. A number below one that the dates have
    already is an error: history is entered in order.
    """
    names = [name for name in rows.columns if name not in (*key, day)]
    given = materialise(
        rows.select(*map(named, [*key, day]), F.struct(*map(named, names)).alias("_new")),
        dates=F.collect_set(named(day)),
    )
    dates = given.observed["dates"] or []
    there = sorted(set(stored_dates(spark, root, day)) & set(dates))
    ids = [*key, day]
    if there:
        stored = read_dates(spark, root, there, day)
        newest = stored.agg(F.greatest(F.max(FROM), F.max(UNTIL)).alias("n")).first().n
        if newest > load:
            raise ValueError(f"load {load} comes after load {newest} of the same dates")
        value = F.struct(*map(named, names))
        closed = stored.where(F.col(UNTIL).isNotNull()).select(*ids, value.alias("_old"), FROM, UNTIL)
        held = stored.where(F.col(UNTIL).isNull()).select(*ids, value.alias("_old"), FROM)
        both = held.join(given.df, ids, "full")
    else:
        closed = None
        both = given.df.withColumn("_old", F.lit(None).cast(given.df.schema["_new"].dataType)).withColumn(
            FROM, F.lit(None).cast("long")
        )
    same = F.col("_old").eqNullSafe(F.col("_new"))
    number = F.lit(load).cast("long")
    opened = F.struct(F.col("_new").alias("value"), number.alias(FROM), F.lit(None).cast("long").alias(UNTIL))
    ended = F.struct(
        F.col("_old").alias("value"), F.col(FROM),
        F.when(~same, number).alias(UNTIL),
    )
    # A row that this load itself had opened before leaves no trace when replaced.
    keep_old = F.col("_old").isNotNull() & (same | (F.col(FROM) < number))
    versions = both.select(
        *ids, (~same).alias("_changed"),
        F.explode(F.array_compact(F.array(
            F.when(keep_old, ended), F.when(~same & F.col("_new").isNotNull(), opened)
        ))).alias("_v"),
    )
    merged = materialise(
        versions.select(*ids, F.col("_v.value").alias("_value"), f"_v.{FROM}", f"_v.{UNTIL}", "_changed"),
        changed=F.count_if("_changed"),
        days=F.collect_set(F.when(F.col("_changed"), named(day))),
    )
    changed = merged.observed["changed"] or 0
    if not changed:
        return 0
    out = merged.df.drop("_changed")
    if closed is not None:
        out = out.unionByName(closed.withColumnRenamed("_old", "_value"))
    # The result replaces partitions that it is read from.
    out = materialise(out.where(named(day).isin(merged.observed["days"]))).df
    (
        out.select(*ids, "_value.*", FROM, UNTIL).hint("rebalance", day)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(root)
    )
    return changed


def read_history(spark: SparkSession, root: str) -> DataFrame:
    return read_snapshots(spark, root)


def known_at(history: DataFrame, load: int) -> DataFrame:
    """The table as it was after a load."""
    holds = (F.col(FROM) <= load) & (F.col(UNTIL).isNull() | (F.col(UNTIL) > load))
    return history.where(holds).drop(FROM, UNTIL)
