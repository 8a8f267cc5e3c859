"""Numbering rows inside groups, whatever the size of a group.

A group that one task can sort is numbered with a window. A group above
``WINDOW_ROWS`` (one snapshot may hold a third of all rows) is numbered in two
passes instead: its rows are range-partitioned over many tasks in the wanted
order and numbered inside each task, then every task's start number is added.
Both ways give the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldrank.materialise import Stored, join_stored, materialise

# Largest group that is sorted inside one task.
WINDOW_ROWS = 2_000_000

# monotonically_increasing_id() keeps the task above this bit, the row below it.
_TASK_SHIFT = 33


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    Spark turns the filter into a group limit that already runs before the
    shuffle, so at most one row per key and map task is moved.
    """
    spot = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_spot", spot).where(F.col("_spot") == 1).drop("_spot")


def group_sizes(df: DataFrame, group: list[str], size: str = "n_rows") -> Stored:
    """Rows per group, written, with the largest one observed."""
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias(size))
    return materialise(counts, largest=F.max(size))


def number_rows(
    df: DataFrame,
    group: list[str],
    orders: dict[str, list[Column]],
    size: str,
    largest: int | None,
    window_rows: int | None = None,
) -> DataFrame:
    """Add one 1..n numbering (bigint) of each group per entry of ``orders``.

    ``size`` is the column holding the row count of the row's group and
    ``largest`` its maximum. Each order must be total within the group.
    """
    limit = WINDOW_ROWS if window_rows is None else window_rows
    if (largest or 0) <= limit:
        return _number_small(df, group, orders)
    small = _number_small(df.where(F.col(size) <= limit), group, orders)
    large = df.where(F.col(size) > limit)
    for out, order in orders.items():
        large = _number_large(large, group, order, out)
    return small.unionByName(large)


def _number_small(df: DataFrame, group: list[str], orders: dict[str, list[Column]]) -> DataFrame:
    # All windows share the group key: one exchange, one sort per order.
    for out, order in orders.items():
        number = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        df = df.withColumn(out, number.cast("bigint"))
    return df


def _number_large(
    df: DataFrame, group: list[str], order: list[Column], out: str
) -> DataFrame:
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(name) for name in group] + order
    placed = materialise(
        df.repartitionByRange(tasks, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    ).df.withColumn("_task", F.shiftright("_place", _TASK_SHIFT))

    runs = _run_starts(placed, group, F.count(F.lit(1)), _first=F.min("_place"))
    number = F.col("_place") - F.col("_first") + F.col("_before") + 1
    return (
        join_stored(placed, materialise(runs), [*group, "_task"])
        .withColumn(out, number.cast("bigint"))
        .drop("_task", "_place", "_first", "_before")
    )


def distribution(
    df: DataFrame,
    group: list[str],
    value: str,
    largest: int | None,
    window_rows: int | None = None,
) -> DataFrame:
    """How often each value occurs in its group (``n_equal``), and how many
    rows of the group have it or a lower one (``n_upto``).

    Equal values are counted before the shuffle, so a group is as large here as
    its number of different values.
    """
    limit = WINDOW_ROWS if window_rows is None else window_rows
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n_equal"))
    upto = Window.partitionBy(*group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    if (largest or 0) <= limit:
        return counts.withColumn("n_upto", F.sum("n_equal").over(upto))
    counts = materialise(counts).df
    if (group_sizes(counts, group).observed["largest"] or 0) <= limit:
        return counts.withColumn("n_upto", F.sum("n_equal").over(upto))

    # Too many different values for one task: add up inside ranges of them.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialise(
        counts.repartitionByRange(tasks, *group, value).withColumn("_task", F.spark_partition_id())
    ).df
    inside = Window.partitionBy(*group, "_task").orderBy(value).rowsBetween(
        Window.unboundedPreceding, 0
    )
    runs = materialise(_run_starts(placed, group, F.sum("n_equal")))
    return (
        join_stored(placed, runs, [*group, "_task"])
        .withColumn("n_upto", F.sum("n_equal").over(inside) + F.col("_before"))
        .drop("_task", "_before")
    )


def _run_starts(placed: DataFrame, group: list[str], amount: Column, **extra: Column) -> DataFrame:
    """One run per task and group, with the amount in the group's earlier runs.

    Ranges are contiguous, so there are at most as many runs as tasks plus
    groups.
    """
    earlier = Window.partitionBy(*group).orderBy("_task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        placed.groupBy(*group, "_task")
        .agg(amount.alias("_run"), *(column.alias(name) for name, column in extra.items()))
        .withColumn("_before", F.coalesce(F.sum("_run").over(earlier), F.lit(0)))
        .drop("_run")
    )


def percent_ranks(
    df: DataFrame,
    group: list[str],
    values: dict[str, str],
    tie_break: str,
    size: str,
    largest: int | None,
    window_rows: int | None = None,
) -> DataFrame:
    """Add the 0..1 percent rank of each value (``out -> value column``).

    Equal values share the rank of their first row. Values are not null.
    """
    limit = WINDOW_ROWS if window_rows is None else window_rows
    small = df if (largest or 0) <= limit else df.where(F.col(size) <= limit)
    for out, value in values.items():
        small = small.withColumn(
            out, F.percent_rank().over(Window.partitionBy(*group).orderBy(value))
        )
    if (largest or 0) <= limit:
        return small
    rows = large = df.where(F.col(size) > limit)
    for out, value in values.items():
        below = (F.col("n_upto") - F.col("n_equal")).alias("_below")
        found = materialise(
            distribution(rows, group, value, largest, window_rows).select(*group, value, below)
        )
        share = F.when(F.col(size) > 1, F.col("_below") / (F.col(size) - 1)).otherwise(0.0)
        large = (
            join_stored(large, found, [*group, value])
            .withColumn(out, share)
            .drop("_below")
        )
    return small.unionByName(large)
