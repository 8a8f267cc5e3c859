"""Running values inside groups of any size.

Rows are range-partitioned by group and order, so a group that holds most of the
table spreads over many tasks. Each task runs its own window; then each part of a
group that began in an earlier task gets the value carried over from there. Only
the groups at the borders of tasks are carried, at most one per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldrank.materialise import materialise


def running(
    df: DataFrame,
    group: list[str],
    order: list[str],
    value: str,
    out: str,
    kind: str = "last",
    before_only: bool = False,
) -> DataFrame:
    """Add the last known (``last``) or highest (``max``) value up to each row.

    Rows follow ``order`` ascending; with ``before_only`` the row itself does not
    count. Group columns are not null. Rows with equal group and order stay in one
    task, so the order should end in a column that differs between rows.
    """
    if kind not in ("last", "max"):
        raise ValueError(f"kind must be 'last' or 'max', not {kind!r}")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = [*group, *order]
    placed = materialise(
        df.repartitionByRange(tasks, *place).sortWithinPartitions(*place)
        .withColumn("_task", F.spark_partition_id())
    ).df

    def over(column: Column, window) -> Column:
        found = F.max(column) if kind == "max" else F.last(column, ignorenulls=True)
        return found.over(window)

    rows = Window.partitionBy("_task", *group).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1 if before_only else 0
    )
    earlier = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    opening = placed.groupBy("_task").agg(F.min(F.struct(*group)).alias("_g")).select("_g.*").distinct()
    newest = F.when(F.col(value).isNotNull(), F.struct(*order))
    total = F.max(value) if kind == "max" else F.max_by(value, newest)
    carried = materialise(
        placed.join(F.broadcast(opening), group).groupBy("_task", *group).agg(total.alias("_total"))
        .select("_task", *group, over(F.col("_total"), earlier).alias("_carried"))
        .where(F.col("_carried").isNotNull())
    ).df
    # At most one row per task and border group.
    local = placed.withColumn(out, over(F.col(value), rows)).join(
        F.broadcast(carried), ["_task", *group], "left"
    )
    both = F.greatest(out, "_carried") if kind == "max" else F.coalesce(out, "_carried")
    return local.withColumn(out, both).drop("_task", "_carried")
