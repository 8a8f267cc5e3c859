"""Statistics of each snapshot, and how rows get them.

All of them are computed for every snapshot in one aggregation with map-side
partials, so a snapshot of any size sends one row per task. The result has one
row per date; it is written once, its size is measured, and rows receive it by
a join that broadcasts only below the measured bound.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldrank.functions.measures import mean_price
from fieldrank.materialise import Stored, join_stored, materialise
from fieldrank.operators.ranking import distribution
from fieldrank.roles import DEFAULT_ROLES, Roles

# Tier cut points and the relative rank error of the quantiles.
TIER_CUTS = (0.33, 0.66)
RANK_ERROR = 0.01

SIZE = "n_rows"


@dataclass(frozen=True)
class SnapshotStatistics:
    """Written statistics, one row per snapshot."""

    stored: Stored
    largest: int

    @property
    def df(self) -> DataFrame:
        return self.stored.df


def with_mean_price(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return df.withColumn("mean_price", mean_price(F.col(roles.price_in), F.col(roles.price_out)))


def approx_quantiles(value: str, cuts: tuple[float, ...], rank_error: float = RANK_ERROR):
    return F.percentile_approx(value, F.array(*map(F.lit, cuts)), F.lit(round(1 / rank_error)))


def summarise(
    df: DataFrame,
    roles: Roles = DEFAULT_ROLES,
    cuts: tuple[float, float] | None = TIER_CUTS,
    moments: bool = False,
) -> DataFrame:
    """Bounds, size and (with ``cuts``) approximate price quantiles per snapshot.

    Expects ``mean_price``. ``moments`` adds mean and deviation of the metrics.
    """
    values = {"quality": roles.quality, "speed": roles.speed, "price": "mean_price"}
    parts = [F.count(F.lit(1)).alias(SIZE)]
    for name, column in values.items():
        parts += [F.min(column).alias(f"{name}_lo"), F.max(column).alias(f"{name}_hi")]
        if moments:
            parts += [
                F.avg(column).alias(f"{name}_mean"),
                F.stddev_pop(column).alias(f"{name}_dev"),
            ]
    if cuts is None:
        return df.groupBy(roles.snapshot_date).agg(*parts)
    parts.append(approx_quantiles("mean_price", cuts).alias("_cuts"))
    return (
        df.groupBy(roles.snapshot_date)
        .agg(*parts)
        .withColumns({"tier_low": F.col("_cuts")[0], "tier_mid": F.col("_cuts")[1]})
        .drop("_cuts")
    )


def measure(
    df: DataFrame,
    roles: Roles = DEFAULT_ROLES,
    cuts: tuple[float, float] | None = TIER_CUTS,
    exact: bool = False,
    moments: bool = False,
    window_rows: int | None = None,
) -> SnapshotStatistics:
    """:func:`summarise`, written; ``exact`` replaces the approximate quantiles."""
    lazy = summarise(df, roles, None if exact else cuts, moments)
    stored = materialise(lazy, largest=F.max(SIZE))
    largest = stored.observed["largest"] or 0
    if exact and cuts is not None:
        found = exact_quantiles(
            df, "mean_price", cuts, ("tier_low", "tier_mid"),
            SnapshotStatistics(stored, largest), roles, window_rows,
        )
        stored = materialise(stored.df.join(found, roles.snapshot_date))
    return SnapshotStatistics(stored, largest)


def attach(
    df: DataFrame, statistics: SnapshotStatistics, roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """Give every row the statistics of its snapshot."""
    return join_stored(
        df, statistics.stored, [roles.snapshot_date]
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    cuts: tuple[float, ...],
    names: tuple[str, ...],
    statistics: SnapshotStatistics,
    roles: Roles = DEFAULT_ROLES,
    window_rows: int | None = None,
) -> DataFrame:
    """Per snapshot, the lowest value that at least a share ``cut`` of rows reaches.

    That is the value at position ``ceil(cut * n)``, read from the counts of
    the different values, so no snapshot is ever held in one buffer. ``value``
    must not be null.
    """
    day = roles.snapshot_date
    spread = distribution(
        df.select(day, value), [day], value, statistics.largest, window_rows
    )
    size = Stored(
        statistics.df.select(day, SIZE), statistics.stored.rows, statistics.stored.nbytes
    )
    picks = []
    for cut, name in zip(cuts, names):
        position = F.ceil(F.col(SIZE).cast("decimal(19,0)") * F.lit(Decimal(str(cut))))
        picks.append(F.min(F.when(F.col("n_upto") >= position, F.col(value))).alias(name))
    return join_stored(spread, size, [day]).groupBy(day).agg(*picks)
