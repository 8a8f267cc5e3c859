"""Mergeable states per date: quantile sketches and sets of entities.

A state is one row per date: rows, a KLL sketch of each measured column and a theta
sketch of the entities. Quantiles of any span of dates, and how many entities two
dates share, come from stored states alone; a reload rebuilds the states of its
dates. A state has a bounded size however large the date is: ``k`` sets the rank
error of the quantiles (about 0.4 % at 800), ``2 ** lg_entries`` the number of
entities up to which a set is exact (beyond it the error is about ``2 ** (-lg_entries / 2)``
of the union).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldrank.names import named
from fieldrank.roles import DEFAULT_ROLES, Roles
from fieldrank.sources.store import read_dates, read_snapshots

QUANTILE_K = 800
LG_ENTRIES = 16


def date_states(
    df: DataFrame,
    columns: list[str],
    roles: Roles = DEFAULT_ROLES,
    k: int = QUANTILE_K,
    lg_entries: int = LG_ENTRIES,
) -> DataFrame:
    """One state per date, by one aggregation with map-side partials.

    Nulls and NaN are in no quantile sketch, a null entity is in no set.
    """
    def measured(name: str):
        value = named(name).cast("double")
        return F.when(~F.isnan(value), value)

    return df.groupBy(roles.snapshot_date).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(measured(name)).alias(f"{name}_n") for name in columns],
        *[F.kll_sketch_agg_double(measured(name), k).alias(f"{name}_kll") for name in columns],
        F.theta_sketch_agg(F.col(roles.entity_id), lg_entries).alias("entities"),
    )


def write_states(states: DataFrame, root: str, roles: Roles = DEFAULT_ROLES) -> None:
    """Replace the states of the dates in ``states``; others stay as they are."""
    (
        states.repartition(roles.snapshot_date).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(roles.snapshot_date).parquet(root)
    )


def refresh_states(
    spark: SparkSession,
    table_root: str,
    states_root: str,
    dates: list[dt.date],
    columns: list[str],
    roles: Roles = DEFAULT_ROLES,
    **sizes: int,
) -> None:
    """Rebuild the states of changed dates from the rows of those dates."""
    if dates:
        rows = read_dates(spark, table_root, dates, roles.snapshot_date)
        write_states(date_states(rows, columns, roles, **sizes), states_root, roles)


def read_states(spark: SparkSession, root: str, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return read_snapshots(spark, root, day=roles.snapshot_date)


def span_quantiles(
    states: DataFrame,
    column: str,
    days: int | None,
    cuts: list[float],
    roles: Roles = DEFAULT_ROLES,
) -> DataFrame:
    """Quantiles of the ``days`` up to each stored date; of all dates with None.

    ``n_values`` counts the values, ``quantiles`` are null where there are none. A
    date's state is repeated once per span that it is in, never its rows.
    """
    day = roles.snapshot_date
    parts = states.select(
        F.col(day).alias("_d"), F.col(f"{column}_n").alias("_n"), F.col(f"{column}_kll").alias("_kll")
    )
    if days is None:
        last = states.agg(F.max(day).alias(day))
        grouped = parts.crossJoin(F.broadcast(last)).groupBy(day)  # one row
    else:
        dates = states.select(day)
        inside = states.select(
            F.col(day).alias("_d"), F.explode(F.sequence(F.col(day), F.date_add(day, days - 1))).alias(day)
        )
        grouped = inside.join(dates, day).join(parts, "_d").groupBy(day)
    merged = grouped.agg(
        F.sum("_n").alias("n_values"),
        F.kll_merge_agg_double(F.when(F.col("_n") > 0, F.col("_kll"))).alias("_kll"),
    )
    found = F.array(*[F.kll_sketch_get_quantile_double("_kll", F.lit(float(cut))) for cut in cuts])
    return merged.select(
        day, F.lit(days).cast("int").alias("days"), "n_values",
        F.when(F.col("n_values") > 0, found).alias("quantiles"),
    )


def neighbour_dates(states: DataFrame, steps: int = 1, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Each stored date as ``newer`` with the date ``steps`` before it as ``older``."""
    day = roles.snapshot_date
    calendar = Window.orderBy(day)  # over one row per date
    pairs = states.select(F.col(day).alias("newer"), F.lag(day, steps).over(calendar).alias("older"))
    return pairs.where("older is not null")


def set_changes(states: DataFrame, pairs: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """How many entities stayed, came and went between pairs of dates (``older``, ``newer``)."""
    day = roles.snapshot_date
    old = states.select(F.col(day).alias("older"), F.col("entities").alias("_old"))
    new = states.select(F.col(day).alias("newer"), F.col("entities").alias("_new"))

    def size(sketch):
        return F.theta_sketch_estimate(sketch)

    return pairs.join(old, "older").join(new, "newer").select(
        "older", "newer",
        size(F.theta_intersection("_old", "_new")).alias("kept"),
        size(F.theta_difference("_new", "_old")).alias("entered"),
        size(F.theta_difference("_old", "_new")).alias("dropped"),
    )


def span_entities(
    states: DataFrame, roles: Roles = DEFAULT_ROLES, lg_entries: int = LG_ENTRIES
) -> DataFrame:
    """Distinct entities of each month, from the states of its dates."""
    month = F.trunc(roles.snapshot_date, "month").alias("month")
    return states.groupBy(month).agg(
        F.theta_sketch_estimate(F.theta_union_agg("entities", lg_entries)).alias("entities")
    )
