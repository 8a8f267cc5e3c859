"""The skyline of price against quality: rows that no other row of their snapshot beats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldrank.materialise import join_stored, materialise
from fieldrank.operators.running import running

# Parts whose skylines are merged into one in a step.
MERGED = 16


def skyline(
    df: DataFrame, price: str, quality: str, day: str, parts: int | None = None
) -> DataFrame:
    """Rows of each snapshot that none is both as good and cheaper, or as cheap and better.

    Equal rows stay together; rows without price or quality are on no skyline. Parts
    of a snapshot get skylines of their own, which drop most points, and are merged
    sixteen at a time; the last merge runs along price ranges, so a snapshot whose
    points are all on its skyline spreads over tasks as well.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = (
        df.where(F.col(price).isNotNull() & F.col(quality).isNotNull())
        .groupBy(F.col(day).alias("_day"), F.col(price).alias("_price"))
        .agg(F.max(quality).alias("_best"))
        .withColumn("_part", F.pmod(F.xxhash64("_price"), F.lit(parts)))
    )
    while parts > 1:
        cheaper = Window.partitionBy("_day", "_part").orderBy("_price").rowsBetween(
            Window.unboundedPreceding, -1
        )
        parts = -(-parts // MERGED)
        points = (
            points.withColumn("_before", F.max("_best").over(cheaper))
            .where("_before is null or _best > _before").drop("_before")
            .withColumn("_part", F.pmod("_part", F.lit(parts)))
        )
    merged = running(
        points.drop("_part"), ["_day"], ["_price"], "_best", "_before", "max", before_only=True
    ).where("_before is null or _best > _before")
    front = materialise(merged.select(
        F.col("_day").alias(day), F.col("_price").alias(price), F.col("_best").alias(quality)
    ))
    return join_stored(df, front, [day, price, quality], "left_semi")
