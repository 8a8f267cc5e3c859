"""Reports on a leaderboard table. Ranks are stored, so these only filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldrank.materialise import join_stored, materialise
from fieldrank.operators.snapshots import Day, snapshot
from fieldrank.roles import DEFAULT_ROLES, Roles


def best_overall(board: DataFrame) -> DataFrame:
    """The winner of every snapshot by score."""
    return board.where(F.col("rank") == 1)


def best_value(board: DataFrame) -> DataFrame:
    """The winner of every snapshot by quality per price."""
    return board.where(F.col("efficiency_rank") == 1)


def top_n(board: DataFrame, day: Day, n: int = 10, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """The first ``n`` of one snapshot, in rank order."""
    return snapshot(board, day, roles).orderBy("rank").limit(n)


def top_n_per_snapshot(board: DataFrame, n: int = 5) -> DataFrame:
    return board.where(F.col("rank") <= n)


def ever_top_n(board: DataFrame, n: int = 5, key: str = DEFAULT_ROLES.entity_id) -> DataFrame:
    """Every row of the entities that were in the top ``n`` of any snapshot.

    ``key`` is the column that identifies an entity; names may be shared, ids
    are not.
    """
    winners = materialise(top_n_per_snapshot(board, n).select(key).distinct())
    return join_stored(board, winners, [key], "left_semi")


def series(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Rows in order of entity and date, for plotting one line per entity."""
    return df.orderBy(roles.entity_id, roles.snapshot_date)


def tiered(board: DataFrame) -> DataFrame:
    return board.where("cost_tier IS NOT NULL")


def tier_summary(board: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Size, price range and quality of each cost tier of each snapshot."""
    return tiered(board).groupBy(roles.snapshot_date, "cost_tier").agg(
        F.count(F.lit(1)).alias("entities"),
        F.min("mean_price").alias("price_lo"),
        F.max("mean_price").alias("price_hi"),
        F.avg("mean_price").alias("price_avg"),
        F.min("quality_norm").alias("quality_norm_lo"),
        F.max("quality_norm").alias("quality_norm_hi"),
        F.avg("quality_norm").alias("quality_norm_avg"),
    )
