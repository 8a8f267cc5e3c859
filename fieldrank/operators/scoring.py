"""The scoring chain of the leaderboard, for all snapshots in one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldrank.functions import norms
from fieldrank.functions.measures import mean_price
from fieldrank.operators.ranking import number_rows, percent_ranks
from fieldrank.operators.statistics import (
    SIZE,
    TIER_CUTS,
    SnapshotStatistics,
    attach,
    measure,
    with_mean_price,
)
from fieldrank.roles import DEFAULT_ROLES, Roles


@dataclass(frozen=True)
class Weights:
    """Shares of the three norms in the score. The defaults."""

    quality: float = 0.50
    speed: float = 0.30
    price: float = 0.20


@dataclass(frozen=True)
class Scaling:
    """How metrics are brought to 0..100.

    ``method`` is ``min_max``, ``percent_rank`` or ``z_score`` (cut at
    ``clip`` deviations); ``log_price`` takes the logarithm of the price first
    and goes with ``min_max``.
    """

    method: str = "min_max"
    log_price: bool = False
    clip: float = 3.0

    def __post_init__(self):
        if self.method not in ("min_max", "percent_rank", "z_score"):
            raise ValueError(f"unknown scaling method: {self.method}")
        if self.log_price and self.method != "min_max":
            raise ValueError("log_price goes with min_max only")


def scorable(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Rows with every metric present and a mean price above zero."""
    for name in roles.metrics:
        df = df.where(F.abs(F.col(name)) < F.lit(float("inf")))  # null, NaN and infinity fail
    return df.where(mean_price(F.col(roles.price_in), F.col(roles.price_out)) > 0)


def with_norms(
    df: DataFrame,
    scaling: Scaling = Scaling(),
    roles: Roles = DEFAULT_ROLES,
    largest: int = 0,
    window_rows: int | None = None,
) -> DataFrame:
    """Add ``quality_norm``, ``speed_norm`` and ``price_norm``.

    Expects the snapshot statistics on each row.
    """
    metrics = {"quality": roles.quality, "speed": roles.speed, "price": "mean_price"}
    if scaling.method == "percent_rank":
        return _percent_rank_norms(df, metrics, roles, largest, window_rows)
    if scaling.method == "z_score":
        return df.withColumns({
            f"{name}_norm": _z_norm(name, column, scaling.clip)
            for name, column in metrics.items()
        })
    price = norms.inverse_log_min_max if scaling.log_price else norms.inverse_min_max
    scale = {"quality": norms.min_max, "speed": norms.min_max, "price": price}
    return df.withColumns({
        f"{name}_norm": scale[name](F.col(column), F.col(f"{name}_lo"), F.col(f"{name}_hi"))
        for name, column in metrics.items()
    })


def _z_norm(name: str, column: str, clip: float) -> Column:
    z = norms.clipped_z(F.col(column), F.col(f"{name}_mean"), F.col(f"{name}_dev"), clip)
    return norms.z_to_scale(-z if name == "price" else z, clip)


def _percent_rank_norms(df, metrics, roles, largest, window_rows) -> DataFrame:
    ranked = percent_ranks(
        df, [roles.snapshot_date],
        {f"{name}_norm": column for name, column in metrics.items()},
        roles.entity_id, SIZE, largest, window_rows,
    )
    shares = {}
    for name in metrics:
        share = F.col(f"{name}_norm")
        if name == "price":
            share = F.lit(1.0) - share
        flat = F.col(f"{name}_lo") == F.col(f"{name}_hi")
        shares[f"{name}_norm"] = F.when(flat, F.lit(norms.FLAT)).otherwise(share * 100.0)
    return ranked.withColumns(shares)


def composite_score(weights: Weights = Weights()) -> Column:
    return norms.weighted_sum([
        (F.col("quality_norm"), weights.quality),
        (F.col("speed_norm"), weights.speed),
        (F.col("price_norm"), weights.price),
    ])


def value_ratio(roles: Roles = DEFAULT_ROLES) -> Column:
    """Quality per unit of mean price; null where the price is zero."""
    return F.try_divide(F.col(roles.quality), F.col("mean_price"))


def cost_tier() -> Column:
    """Tier of the mean price against the cut points of its snapshot."""
    # The names of the tiers.
    price = F.col("mean_price")
    return (
        F.when(price <= F.col("tier_low"), F.lit("budget"))
        .when(price <= F.col("tier_mid"), F.lit("mid"))
        .otherwise(F.lit("premium"))
    )


def rank_order(column: str, roles: Roles = DEFAULT_ROLES) -> list[Column]:
    """Highest first; the entity id settles ties."""
    return [F.col(column).desc(), F.col(roles.entity_id)]


def scored(
    df: DataFrame,
    weights: Weights = Weights(),
    scaling: Scaling = Scaling(),
    roles: Roles = DEFAULT_ROLES,
    cuts: tuple[float, float] | None = TIER_CUTS,
    exact_cuts: bool = False,
    window_rows: int | None = None,
) -> tuple[DataFrame, SnapshotStatistics]:
    """Scorable rows with norms, score, ratio and (with ``cuts``) tier."""
    eligible = with_mean_price(scorable(df.select(*roles.columns), roles), roles)
    statistics = measure(
        eligible, roles, cuts, exact_cuts, scaling.method == "z_score", window_rows
    )
    rows = with_norms(
        attach(eligible, statistics, roles), scaling, roles, statistics.largest, window_rows
    )
    extra = {"composite_score": composite_score(weights), "value_ratio": value_ratio(roles)}
    if cuts is not None:
        extra["cost_tier"] = cost_tier()
    return rows.withColumns(extra), statistics


def leaderboard(
    df: DataFrame,
    weights: Weights = Weights(),
    scaling: Scaling = Scaling(),
    roles: Roles = DEFAULT_ROLES,
    cuts: tuple[float, float] = TIER_CUTS,
    exact_cuts: bool = False,
    window_rows: int | None = None,
) -> DataFrame:
    """Ranked entities of every snapshot in ``df``.

    Each snapshot is scored against its own field only. The statistics are
    computed when this is called; ranking and the rest run with the caller's
    action.
    """
    rows, statistics = scored(df, weights, scaling, roles, cuts, exact_cuts, window_rows)
    output = [
        roles.snapshot_date, *roles.identity, "composite_score", "quality_norm",
        "speed_norm", "price_norm", "mean_price", "value_ratio", "cost_tier",
    ]
    ranked = number_rows(
        rows.select(*output, SIZE),
        [roles.snapshot_date],
        {
            "rank": rank_order("composite_score", roles),
            "efficiency_rank": rank_order("value_ratio", roles),
        },
        SIZE, statistics.largest, window_rows,
    )
    return ranked.select(
        roles.snapshot_date, "rank", *roles.identity, *output[4:], "efficiency_rank"
    )
