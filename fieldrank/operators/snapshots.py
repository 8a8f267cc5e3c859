"""Slices of a snapshot table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldrank.operators.ranking import keep_first
from fieldrank.roles import DEFAULT_ROLES, Roles

Day = dt.date | str


def snapshot(df: DataFrame, day: Day, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """One snapshot. The date column stays bare, so partitions are pruned."""
    return df.where(F.col(roles.snapshot_date) == F.lit(day).cast("date"))


def latest_date(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return df.agg(F.max(roles.snapshot_date).alias(roles.snapshot_date))


def latest_snapshot(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """The newest snapshot of any frame; the scalar subquery prunes partitions when
    it runs. Of a stored table ``store.read_latest`` reads one folder."""
    return df.where(F.col(roles.snapshot_date) == latest_date(df, roles).scalar())


def as_of(df: DataFrame, day: Day, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """How the table looked on ``day``: each entity's newest row up to then."""
    known = df.where(F.col(roles.snapshot_date) <= F.lit(day).cast("date"))
    return keep_first(known, [roles.entity_id], [F.col(roles.snapshot_date).desc()])
