"""Means, slopes and volatility over days of the calendar.

A frame of ``days`` ends at the row's own date and reaches back by days, not by rows,
so gaps in the snapshots stay gaps; rows of one date belong to the same frames. Input is
unique by entity and date, which bounds the rows of an entity by the calendar.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldrank.roles import DEFAULT_ROLES, Roles

DAYS = (7, 30)


def calendar_windows(
    df: DataFrame, values: list[str], days: tuple[int, ...] = DAYS, roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """Per row, value and frame: rows with a value, their mean, the sample deviation
    (``volatility``, null below two rows) and the slope per day (null below two dates).

    NaN counts as null. All frames share one exchange and one sort.
    """
    entity, day = roles.entity_id, roles.snapshot_date
    number = F.unix_date(day)
    by_entity = Window.partitionBy(entity).orderBy(number)
    output = {}
    for name in values:
        value = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
        for length in days:
            frame = by_entity.rangeBetween(1 - length, 0)
            output |= {
                f"{name}_{length}d_n": F.count(value).over(frame),
                f"{name}_{length}d_mean": F.avg(value).over(frame),
                f"{name}_{length}d_volatility": F.stddev_samp(value).over(frame),
                f"{name}_{length}d_slope": F.regr_slope(value, number.cast("double")).over(frame),
            }
    return df.select(entity, day, *dict.fromkeys(values)).select(
        entity, day, *(column.alias(name) for name, column in output.items())
    )


def windows_after(
    cleaned: DataFrame,
    changed: list[dt.date],
    values: list[str],
    days: tuple[int, ...] = DAYS,
    roles: Roles = DEFAULT_ROLES,
) -> DataFrame:
    """The partitions of a window table that new or reloaded dates change, complete.

    These are the changed dates and those that a frame reaches back from to one of them;
    read are only they and the days their own frames reach. Both sets are bounded by the
    frames, so the dates are listed and prune the partitions of ``cleaned``.
    """
    day, reach = roles.snapshot_date, max(days, default=1) - 1
    rewritten = {date + dt.timedelta(days=n) for date in changed for n in range(reach + 1)}
    read = {date - dt.timedelta(days=n) for date in rewritten for n in range(reach + 1)}
    rows = cleaned.where(F.col(day).isin(sorted(read)))
    return calendar_windows(rows, values, days, roles).where(F.col(day).isin(sorted(rewritten)))
