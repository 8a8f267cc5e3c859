"""Spells of presence: runs of neighbouring snapshots that an entity is in.

Neighbours are dates that follow each other in the table, whatever lies between.
Input is unique by entity and date, so an entity's window is bounded by the number
of dates, and only dates (never rows) are numbered over the whole table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldrank.materialise import Stored, join_stored, materialise
from fieldrank.roles import DEFAULT_ROLES, Roles


def _calendar(df: DataFrame, roles: Roles) -> Stored:
    day = roles.snapshot_date
    number = F.row_number().over(Window.orderBy(day))  # over distinct dates only
    return materialise(df.select(day).distinct().withColumn("_number", number))


def _islands(rows: DataFrame, calendar: Stored, roles: Roles) -> DataFrame:
    day, entity = roles.snapshot_date, roles.entity_id
    by_entity = Window.partitionBy(entity).orderBy(day)
    return (
        join_stored(rows, calendar, [day])
        .withColumn("_island", F.col("_number") - F.row_number().over(by_entity))
        .groupBy(entity, "_island")
        .agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"), F.count(day).alias("n_snapshots"))
        .drop("_island")
    )


def spells(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Each entity's spells: first and last date, and the snapshots between."""
    return _islands(df.select(roles.entity_id, roles.snapshot_date), _calendar(df, roles), roles)


def spells_after(
    cleaned: DataFrame, current: DataFrame, changed: list[dt.date], roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """All spells after new or reloaded dates, from the spells before and those dates.

    Only spells that cover a changed date or end beside one are taken apart; of the
    table's rows only those of the changed dates are read. ``changed`` names a few
    dates, so what is compared with every spell is small.
    """
    day, entity = roles.snapshot_date, roles.entity_id
    if not changed:
        return current
    calendar = _calendar(cleaned, roles)
    places = Window.orderBy(day)
    near = calendar.df.select(
        day, F.lag(day).over(places).alias("_before"), F.lead(day).over(places).alias("_after")
    ).where(F.col(day).isin(changed)).select(
        F.explode(F.array_compact(F.array(day, "_before", "_after"))).alias("_near")
    ).distinct()
    beside = F.col("_near").between(F.col("first_date"), F.col("last_date"))
    touched = current.join(F.broadcast(near), beside, "left_semi")
    kept = current.join(F.broadcast(near), beside, "left_anti")
    # A spell has at most as many dates as the calendar.
    inside = F.col(day).between(F.col("first_date"), F.col("last_date"))
    dates = F.broadcast(calendar.df.select(day)) if calendar.fits_broadcast else calendar.df.select(day)
    apart = touched.join(dates, inside).where(~F.col(day).isin(changed)).select(entity, day)
    now = cleaned.where(F.col(day).isin(changed)).select(entity, day)
    return kept.unionByName(_islands(apart.union(now), calendar, roles).select(*current.columns))
