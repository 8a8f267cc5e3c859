"""How the field and the ranking change between snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldrank.materialise import join_stored, materialise
from fieldrank.operators.scoring import Weights, composite_score
from fieldrank.roles import DEFAULT_ROLES, Roles


def rank_movement(board: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Places gained (positive) or lost since the entity was last ranked."""
    by_entity = Window.partitionBy(roles.entity_id).orderBy(roles.snapshot_date)
    return board.select(
        *roles.identity,
        roles.snapshot_date,
        F.lag(roles.snapshot_date).over(by_entity).alias("prev_snapshot_date"),
        "rank",
        F.lag("rank").over(by_entity).alias("rank_previous"),
        (F.lag("rank").over(by_entity) - F.col("rank")).alias("places_gained"),
        (
            F.col("composite_score") - F.lag("composite_score").over(by_entity)
        ).alias("score_delta"),
    )


def entered_dropped(
    df: DataFrame, roles: Roles = DEFAULT_ROLES, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Entities that appear or are gone compared with the snapshot before.

    ``keep`` are further columns to return, of the first row or of the last one.

    Neighbouring snapshots come from the list of distinct dates; an entity's
    own neighbours come from one window by entity, so no row pairs are built.
    """
    day = roles.snapshot_date
    calendar = Window.orderBy(day)  # over distinct dates only
    dates = materialise(
        df.select(day).distinct().select(
            day,
            F.lag(day).over(calendar).alias("_before"),
            F.lead(day).over(calendar).alias("_after"),
        )
    )
    by_entity = Window.partitionBy(roles.entity_id).orderBy(day)
    rows = join_stored(
        df.select(roles.entity_id, day, *keep), dates, [day]
    ).withColumns({
        "_last": F.lag(day).over(by_entity),
        "_next": F.lead(day).over(by_entity),
    })
    entered = F.when(
        F.col("_before").isNotNull() & ~F.col("_last").eqNullSafe(F.col("_before")),
        F.struct(F.col(day).alias("day"), F.lit("entered").alias("change")),
    )
    dropped = F.when(
        F.col("_after").isNotNull() & ~F.col("_next").eqNullSafe(F.col("_after")),
        F.struct(F.col("_after").alias("day"), F.lit("dropped").alias("change")),
    )
    changes = rows.select(
        roles.entity_id, *keep, F.explode(F.array_compact(F.array(entered, dropped))).alias("_c")
    )
    return changes.select(
        F.col("_c.day").alias(day), roles.entity_id, F.col("_c.change").alias("change"), *keep
    )


def reweighted_winner(
    rows: DataFrame, weights: dict[str, Weights], roles: Roles = DEFAULT_ROLES
) -> DataFrame:
    """The winner of each snapshot under each set of weights.

    ``rows`` carry the three norms. Each set is one aggregate of the same pass
    (lowest negated score, then lowest id), so rows are not multiplied.
    """
    day = roles.snapshot_date

    def entry(item: Weights):
        return F.struct(
            (-composite_score(item)).alias("lost"),
            F.col(roles.entity_id).alias("id"),
            F.col(roles.entity_name).alias("name"),
        )

    best = rows.groupBy(day).agg(
        *(F.min(entry(item)).alias(f"_{i}") for i, item in enumerate(weights.values()))
    )
    choices = F.array(*(
        F.struct(F.lit(name).alias("weighting"), F.col(f"_{i}").alias("best"))
        for i, name in enumerate(weights)
    ))
    return best.select(day, F.explode(choices).alias("_w")).select(
        day,
        F.col("_w.weighting").alias("weighting"),
        F.col("_w.best.id").alias(roles.entity_id),
        F.col("_w.best.name").alias(roles.entity_name),
        (-F.col("_w.best.lost")).alias("composite_score"),
    )
