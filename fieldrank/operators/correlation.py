"""Rank correlation between snapshots: Kendall's tau-b without a table of pairs.

With entities ordered by their value before (ties by the value now), the discordant
pairs are the inversions of the value now. They are counted in three parts: inside
ranges of the value before; inside ranges of the value now, between entities of
different ranges before; and between entities that differ in both ranges, where counts
per pair of ranges suffice. A range holds about ``ROWS_PER_RANGE`` rows, so a snapshot
that holds most of the table is spread over many tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldrank.materialise import join_stored, materialise
from fieldrank.roles import DEFAULT_ROLES, Roles

# Rows of different values that one task counts in memory.
ROWS_PER_RANGE = 1_000_000


def inversions(values: np.ndarray, weights: np.ndarray) -> int:
    """Weighted pairs i < j with ``values[i] > values[j]``.

    Values are taken apart bit by bit of their dense rank: two values invert at the
    highest bit in which they differ, so each bit needs one running sum.
    """
    ranks = np.unique(values, return_inverse=True)[1].reshape(-1)
    weights = weights.astype(np.int64)
    total = 0
    for bit in range(int(ranks.max(initial=0)).bit_length() - 1, -1, -1):
        above = ranks >> (bit + 1)
        order = np.argsort(above, kind="stable")
        group, high = above[order], (ranks[order] >> bit) & 1
        weight = weights[order]
        ones = np.cumsum(weight * high)
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        before = np.r_[0, ones][starts]
        inside = ones - np.repeat(before, np.diff(np.r_[starts, len(group)]))
        total += int(np.sum(weight * (1 - high) * inside))
    return total


def _counted(rows: DataFrame, day: str, group: str | None, order: str, value: str) -> DataFrame:
    """Inversions of ``value`` along (``order``, ``value``) per date and range."""
    schema = T.StructType([rows.schema[day], T.StructField("_inverted", T.LongType())])

    def count(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values([order, value])
        found = inversions(part[value].to_numpy(), part["_n"].to_numpy())
        return pd.DataFrame({day: [key[0]], "_inverted": [found]})

    keys = [day] if group is None else [day, group]
    return rows.select(*dict.fromkeys([*keys, order, value, "_n"])).groupBy(*keys).applyInPandas(
        count, schema
    )


def discordant_pairs(
    pairs: DataFrame, day: str, before: str, now: str, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Discordant pairs per date of rows with a value before and one now, neither null."""
    counted = materialise(pairs.groupBy(day, before, now).agg(F.count(F.lit(1)).alias("_n")))
    ranges = -(-counted.rows // rows_per_range)
    if ranges <= 1:
        found = _counted(counted.df, day, None, before, now)
    else:
        # Written, since the bounds of ranges are sampled and have to stay as they are.
        placed = materialise(
            counted.df.repartitionByRange(ranges, day, before, now)
            .withColumn("_before", F.spark_partition_id())
        ).df
        # Equal values go by their range before, so of two the later one is not lower.
        both = materialise(
            placed.repartitionByRange(ranges, day, now, "_before")
            .withColumn("_now", F.spark_partition_id())
        ).df
        cells = both.groupBy(day, "_before", "_now").agg(F.sum("_n").alias("_n"))
        found = (
            _counted(placed, day, "_before", before, now)
            .union(_counted(both, day, "_now", "_before", now))
            .union(_counted(cells, day, None, "_before", "_now"))
        )
    return found.groupBy(day).agg(F.sum("_inverted").alias("discordant"))


def _ties(pairs: DataFrame, day: str, values: list[str], out: str) -> DataFrame:
    groups = pairs.groupBy(day, *values).agg(F.count(F.lit(1)).alias("_n"))
    return groups.groupBy(day).agg(F.sum(_choose_two("_n")).cast("long").alias(out))


def _choose_two(count: str):
    # The even one of two neighbours is halved.
    n = F.col(count)
    return F.when(n % 2 == 0, F.expr(f"{count} div 2") * (n - 1)).otherwise(
        n * F.expr(f"({count} - 1) div 2")
    )


def rank_correlation(
    df: DataFrame,
    value: str,
    steps: int = 1,
    roles: Roles = DEFAULT_ROLES,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Kendall's tau-b of each snapshot with the one ``steps`` snapshots before it.

    ``df`` is unique by entity and date. Entities count that have a value in both
    snapshots; null and NaN are no values. One row per date that has such an earlier
    snapshot: entities, pairs in the same and in opposite order, pairs tied before, now
    and in both, and ``tau_b`` (null without two different values on each side). Counts
    are exact up to three billion entities a snapshot.
    """
    day, entity = roles.snapshot_date, roles.entity_id
    places = Window.orderBy(day)  # over distinct dates only
    calendar = materialise(df.select(day).distinct().select(
        day,
        F.row_number().over(places).alias("_number"),
        F.lag(day, steps).over(places).alias(f"prev_{day}"),
    ))
    known = F.col(value).isNotNull()
    if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
        known &= ~F.isnan(value)
    earlier = Window.partitionBy(entity).orderBy("_number").rangeBetween(-steps, -steps)
    rows = join_stored(
        df.where(known).select(entity, day, F.col(value).alias("_value")), calendar, [day]
    )
    pairs = materialise(
        rows.withColumn("_earlier", F.first("_value").over(earlier))
        .where(F.col("_earlier").isNotNull()).select(day, "_earlier", "_value")
    ).df
    result = calendar.df.where(F.col(f"prev_{day}").isNotNull()).drop("_number")
    for part in (
        pairs.groupBy(day).agg(F.count(F.lit(1)).alias("n_entities")),
        _ties(pairs, day, ["_earlier"], "tied_before"),
        _ties(pairs, day, ["_value"], "tied_now"),
        _ties(pairs, day, ["_earlier", "_value"], "tied_both"),
        discordant_pairs(pairs, day, "_earlier", "_value", rows_per_range),
    ):
        result = result.join(part, day, "left")
    result = result.na.fill(0, ["n_entities", "tied_before", "tied_now", "tied_both", "discordant"])
    total = _choose_two("n_entities")
    spread = (total - F.col("tied_before")).cast("double") * (total - F.col("tied_now")).cast("double")
    concordant = total - F.col("tied_before") - F.col("tied_now") + F.col("tied_both") - F.col("discordant")
    return result.withColumn("concordant", concordant).withColumn(
        "tau_b",
        F.when(spread > 0, (F.col("concordant") - F.col("discordant")) / F.sqrt(spread)),
    ).select(
        day, f"prev_{day}", "n_entities", "concordant", "discordant",
        "tied_before", "tied_now", "tied_both", "tau_b",
    )
