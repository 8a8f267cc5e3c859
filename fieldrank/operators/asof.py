"""As-of join: each row with the newest row of another series up to its time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldrank.names import named
from fieldrank.operators.running import running


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: dict[str, str],
    left_time: str,
    right_time: str,
    columns: list[str],
    tolerance: Column | None = None,
    matched_time: str = "matched_time",
) -> DataFrame:
    """All rows of ``left`` with ``columns`` of the newest right row not after them.

    ``by`` maps key columns of ``left`` to those of ``right``. ``tolerance`` is an
    interval: an older match is no match. Of several right rows with equal key and
    time the one with the highest ``columns`` counts. A null key or time never
    matches. Both series are united and carried forward in one order, so no row
    pairs arise and one key may hold most of the table.
    """
    keys = [f"_key{i}" for i in range(len(by))]
    there = [named(name) for name in [*by.values(), right_time]]
    known = (
        right.where(_all_known(there))
        .groupBy(*[c.alias(k) for c, k in zip(there, [*keys, "_time"])])
        .agg(F.max(F.struct(*[named(name) for name in columns])).alias("_best"))
    )
    found = F.struct(F.col("_time").alias("time"), F.col("_best").alias("best"))
    side = known.select(
        *keys, "_time", F.lit(0).alias("_side"), F.lit(0).cast("long").alias("_origin"),
        found.alias("_right"), F.lit(None).cast(_row_type(left)).alias("_row"),
    )
    here = [named(name) for name in [*by, left_time]]
    rows = left.select(
        *[c.alias(k) for c, k in zip(here, [*keys, "_time"])], F.lit(1).alias("_side"),
        F.monotonically_increasing_id().alias("_origin"),
        F.lit(None).cast(side.schema["_right"].dataType).alias("_right"),
        F.struct(*[named(name) for name in left.columns]).alias("_row"),
    )
    complete = _all_known([F.col(name) for name in [*keys, "_time"]])
    carried = running(
        side.unionByName(rows.where(complete)), keys, ["_time", "_side", "_origin"], "_right", "_found"
    ).where("_side = 1")
    if tolerance is not None:
        near = F.col("_time") <= F.col("_found.time") + tolerance
        carried = carried.withColumn("_found", F.when(near, F.col("_found")))
    alone = rows.where(~complete).withColumn("_found", F.col("_right"))
    return carried.select("_row", "_found").union(alone.select("_row", "_found")).select(
        *[F.col("_row").getField(name).alias(name) for name in left.columns],
        F.col("_found.time").alias(matched_time),
        *[F.col("_found.best").getField(name).alias(name) for name in columns],
    )


def _all_known(columns: list[Column]) -> Column:
    known = F.lit(True)
    for column in columns:
        known = known & column.isNotNull()
    return known


def _row_type(df: DataFrame):
    return df.select(F.struct(*[named(name) for name in df.columns]).alias("r")).schema["r"].dataType
