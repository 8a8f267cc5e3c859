"""Changes of each entity against its own previous snapshot.

Input is a cleaned table, unique by entity and date, so one entity has at most
one row per snapshot date: the windows by entity are bounded by the calendar,
not by the size of the table.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldrank.materialise import join_stored, materialise
from fieldrank.operators.statistics import with_mean_price
from fieldrank.roles import DEFAULT_ROLES, Roles

# How far back the previous row is looked for before the whole history is read.
LOOKBACK_DAYS = 7


def _tracked(roles: Roles) -> dict[str, str]:
    return {"quality": roles.quality, "speed": roles.speed, "price": "mean_price"}


def with_previous(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Date and metrics of the entity's previous row, however long ago.

    Expects ``mean_price``. All lags share one window.
    """
    by_entity = Window.partitionBy(roles.entity_id).orderBy(roles.snapshot_date)
    lags = {"prev_snapshot_date": F.lag(roles.snapshot_date).over(by_entity)}
    for name, column in _tracked(roles).items():
        lags[f"{name}_previous"] = F.lag(column).over(by_entity)
    return df.withColumns(lags)


def trends(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """One row per input row: current, previous and delta of each metric."""
    day = roles.snapshot_date
    rows = with_previous(with_mean_price(df.select(*roles.columns), roles), roles)
    output = [*map(F.col, roles.identity), F.col(day), F.col("prev_snapshot_date")]
    for name, column in _tracked(roles).items():
        now, before = F.col(column), F.col(f"{name}_previous")
        output += [
            now.alias(f"{name}_current"), before, (now - before).alias(f"{name}_delta"),
        ]
    return rows.select(*output)


def trends_after(
    cleaned: DataFrame,
    current: DataFrame,
    changed: list[dt.date],
    roles: Roles = DEFAULT_ROLES,
    lookback_days: int = LOOKBACK_DAYS,
) -> DataFrame:
    """The partitions of a trends table that new or reloaded dates change.

    ``cleaned`` already holds the new rows of the ``changed`` dates, ``current``
    is the trends table from before. Returned are all rows of the changed dates
    and of each affected entity's next date, complete per date and not read from
    ``current``, so they can replace its partitions. Dates in between stay
    untouched: a daily append rewrites one partition, and a correction reads the
    changed dates, ``lookback_days`` around each of them and the date next to it. Only
    entities that pause for longer are looked for in the dates beyond.
    """
    day, entity = roles.snapshot_date, roles.entity_id
    if not changed:
        return current.limit(0)
    cleaned = cleaned.select(*roles.columns)

    rows = cleaned.where(F.col(day).isin(changed))
    calendar = _dates(cleaned, day)
    if not set(calendar) - set(changed):
        return trends(rows.dropDuplicates([entity, day]), roles)  # no date is left out

    # Entities on the changed dates now, or before the reload removed them.
    gone = current.where(F.col(day).isin(changed)).select(entity, day)
    pairs = rows.select(entity, day).union(gone).distinct()
    affected = materialise(pairs.withColumnRenamed(day, "_changed")).df

    before = _neighbours(cleaned, affected, changed, calendar, roles, lookback_days, -1)
    after = _neighbours(cleaned, affected, changed, calendar, roles, lookback_days, 1)
    # Of these rows each that is returned has its predecessor among them.
    known = rows.unionByName(before).unionByName(after).dropDuplicates([entity, day])
    follows = after.select(entity, day).distinct().withColumn("_follows", F.lit(True))
    marked = (
        trends(known, roles)
        .join(follows, [entity, day], "left")
        .where(F.col(day).isin(changed) | F.col("_follows"))
        .drop("_follows")
    )
    fresh = materialise(marked, days=F.collect_set(day))

    # Other entities' rows on the following dates are carried over as they are.
    following = sorted(set(fresh.observed["days"] or []) - set(changed))
    if not following:
        return fresh.df
    kept = current.where(F.col(day).isin(following)).join(
        fresh.df.select(entity, day), [entity, day], "left_anti"
    )
    return fresh.df.unionByName(materialise(kept.select(*fresh.df.columns)).df)


def _dates(df: DataFrame, day: str) -> list[dt.date]:
    """The dates of a table; of a stored one no values are read."""
    found = (row[0] for row in df.select(day).distinct().collect())
    return sorted(date for date in found if date is not None)


def _neighbours(
    cleaned: DataFrame,
    affected: DataFrame,
    changed: list[dt.date],
    calendar: list[dt.date],
    roles: Roles,
    days: int,
    side: int,
) -> DataFrame:
    """The row next to each pair of entity and changed date, before (``side`` -1)
    or after it (1), written.

    Most entities are there again within some days or at the next date, so those dates
    are read first; beyond them only entities not found are looked for.
    """
    day, entity = roles.snapshot_date, roles.entity_id
    date = F.col(day)
    reach, near = {}, set()
    for start in changed:
        edge = start + dt.timedelta(days=side * days)
        if side < 0:
            at = bisect_left(calendar, start)
            beside = calendar[max(at - 1, 0):at]
            reach[start] = min([edge, *beside])
            near.update(calendar[bisect_left(calendar, reach[start]):at])
        else:
            at = bisect_right(calendar, start)
            beside = calendar[at:at + 1]
            reach[start] = max([edge, *beside])
            near.update(calendar[at:bisect_right(calendar, reach[start])])
    reaches = cleaned.sparkSession.createDataFrame(
        [*reach.items()], "_changed date, _reach date"
    )
    found = _beside(cleaned.where(date.isin(sorted(near))), affected, roles, side)
    found = found.join(F.broadcast(reaches), "_changed")
    inside = date >= F.col("_reach") if side < 0 else date <= F.col("_reach")
    close = materialise(found.where(inside).drop("_reach"))
    unseen = materialise(affected.join(close.df, [entity, "_changed"], "left_anti"))
    found = close.df
    if unseen.rows:
        # Outward from the innermost changed date, to the end of the table.
        edge = F.lit(max(reach.values()) if side < 0 else min(reach.values()))
        rest = cleaned.where(date < edge if side < 0 else date > edge)
        wanted = materialise(unseen.df.select(entity).distinct())
        if wanted.fits_broadcast:  # else the rows move once all the same
            rest = join_stored(rest, wanted, [entity], "left_semi")
        found = found.unionByName(materialise(_beside(rest, unseen.df, roles, side)).df)
    return found.drop("_changed")


def _beside(rows: DataFrame, pairs: DataFrame, roles: Roles, side: int) -> DataFrame:
    """The row next to each pair of entity and ``_changed`` date, before or after it.

    Rows and pairs pass one window by entity, so no row meets all pairs of its entity.
    """
    day, entity = roles.snapshot_date, roles.entity_id
    there = rows.where(F.col(entity).isNotNull()).select(
        entity, F.col(day).alias("_at"), F.struct(*rows.columns).alias("_row")
    )
    spots = pairs.select(
        entity, F.col("_changed").alias("_at"),
        F.lit(None).cast(there.schema["_row"].dataType).alias("_row"),
    )
    # At its own date a pair comes first, so that it does not see that row.
    at = F.col("_at").asc() if side < 0 else F.col("_at").desc()
    upto = Window.partitionBy(entity).orderBy(at, F.col("_row").isNotNull()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    seen = there.union(spots).withColumn("_near", F.last("_row", ignorenulls=True).over(upto))
    return seen.where(F.col("_row").isNull() & F.col("_near").isNotNull()).select(
        "_near.*", F.col("_at").alias("_changed")
    )
