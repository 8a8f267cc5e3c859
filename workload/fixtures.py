"""Snapshot tables derived from the driver's tables.

The driver's tables hold no daily snapshots. Suppliers by month stand in:
summed quantity as quality, returns as speed (none means "not measured"),
lowest discount and tax as prices. All sums are of whole numbers, so results do
not depend on the order of addition.

The snapshot table and its leaderboard are stored once per session, as they
would be in use, and queries read the stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldrank.materialise import scratch_folder
from fieldrank.operators.cleaning import CleaningRules
from fieldrank.operators.scoring import leaderboard
from fieldrank.sources.store import read_snapshots, write_snapshots

_stored: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def build_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.trunc("l_shipdate", "month").alias("snapshot_date"))
        .agg(
            F.sum("l_quantity").alias("quality"),
            F.nullif(
                F.count_if(F.col("l_returnflag") == "R").cast("double"), F.lit(0.0)
            ).alias("speed"),
            F.min("l_discount").alias("price_in"),
            F.min("l_tax").alias("price_out"),
        )
    )
    named = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return measured.join(named, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_suppkey").cast("string").alias("entity_id"),
        F.col("s_name").alias("entity_name"),
        F.col("n_name").alias("group_name"),
        "snapshot_date", "quality", "speed", "price_in", "price_out",
    )


def _stored_table(
    spark: SparkSession, sf_dir: str, name: str, build, contract: str, arranged: bool = False
) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        root = scratch_folder(spark)
        write_snapshots(build(), root, contract=contract, arranged=arranged)
        _stored[key] = root
    return read_snapshots(spark, _stored[key])


def snapshots_root(spark: SparkSession, sf_dir: str) -> str:
    snapshots(spark, sf_dir)
    return _stored[spark.sparkContext.applicationId, sf_dir, "snapshots"]


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_table(
        spark, sf_dir, "snapshots", lambda: build_snapshots(spark, sf_dir), "cleaned"
    )


def board(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_table(
        spark, sf_dir, "board",
        lambda: leaderboard(snapshots(spark, sf_dir), exact_cuts=True), "leaderboard",
        arranged=True,
    )


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of every row, as they might arrive: prices as text, some
    of them no numbers, zero for an unmeasured speed, names missing at times
    in the second delivery, which is otherwise the better one."""
    rows = snapshots(spark, sf_dir).select(
        F.col("entity_id").alias("id"),
        F.col("group_name").alias("maker"),
        F.col("snapshot_date").cast("string").alias("snapshot_date"),
        F.coalesce("speed", F.lit(0.0)).alias("rate"),
        "quality", "entity_name", "price_in", "price_out",
    )
    text_price = F.col("price_in").cast("string")

    def delivery(number: int, shift: float, name, price_in) -> DataFrame:
        return rows.select(
            "id", "maker", "snapshot_date", "rate",
            (F.col("quality") + shift).alias("index_value"), name.alias("slug"),
            price_in.alias("cost_in"),
            F.col("price_out").cast("string").alias("cost_out"),
            F.lit(number).alias("delivery"),
        )

    first = delivery(1, 1.0, F.col("entity_name"), text_price)
    second = delivery(
        2, 0.0,
        F.when(F.col("price_out") != 0.08, F.col("entity_name")),
        F.when(F.col("price_in") == 0.05, F.lit("n/a")).otherwise(text_price),
    )
    return first.unionByName(second)


RAW_RULES = CleaningRules(
    key=("id", "snapshot_date"),
    identity=("id", "slug"),
    dates=("snapshot_date",),
    numbers=("cost_in", "cost_out"),
    zero_is_missing=("rate",),
    newest_first=("delivery",),
    renames={
        "id": "entity_id", "slug": "entity_name", "maker": "group_name",
        "index_value": "quality", "rate": "speed",
        "cost_in": "price_in", "cost_out": "price_out",
    },
)


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by day; users pause, so their previous snapshot may be days back."""
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", F.to_date("ts").alias("snapshot_date"))
        .agg(
            F.max("value").alias("quality"),
            F.count(F.lit(1)).cast("double").alias("speed"),
            F.min("value").alias("price_in"),
            F.max("value").alias("price_out"),
            F.max("event_type").alias("group_name"),
        )
        .select(
            F.col("user_id").cast("string").alias("entity_id"),
            F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("entity_name"),
            "group_name", "snapshot_date", "quality", "speed", "price_in", "price_out",
        )
    )


def _record(entity, name, released, group, price_in, price_out, speed, measurements):
    """One landing record as JSON text, nulls written out."""
    return F.to_json(
        F.struct(
            entity.cast("string").alias("id"),
            name.alias("slug"),
            released.cast("string").alias("release_date"),
            F.struct(group.alias("slug")).alias("model_creator"),
            F.struct(
                price_in.alias("price_1m_input_tokens"),
                price_out.alias("price_1m_output_tokens"),
            ).alias("pricing"),
            speed.alias("median_output_tokens_per_second"),
            F.lit(0.0).alias("median_time_to_first_token_seconds"),
            F.lit(None).cast("double").alias("median_time_to_first_answer_token"),
            measurements.alias("evaluations"),
        ),
        {"ignoreNullFields": "false"},
    )


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as landing records; each has one measurement, named by its type."""
    return table(spark, sf_dir, "part").select(
        F.lit("2024-01-01").cast("date").alias("snapshot_date"),
        _record(
            F.col("p_partkey"), F.col("p_name"), F.lit("2023-05-06"), F.col("p_brand"),
            F.col("p_retailprice"), F.col("p_size").cast("double"), F.lit(0.0),
            F.create_map(F.lower("p_type"), F.col("p_size")),
        ).alias("record"),
    )


def land_snapshots(spark: SparkSession, sf_dir: str) -> str:
    """The snapshot table as landing files, one envelope per line in a folder
    per date; returns the folder."""
    path = scratch_folder(spark)
    rows = snapshot_lines(spark, sf_dir)
    rows.hint("rebalance", "snapshot_date").write.partitionBy("snapshot_date").text(path)
    return path


def snapshot_lines(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """An envelope (``value``) per row of the snapshot table."""
    return snapshots(spark, sf_dir).select(
        "snapshot_date", *more,
        F.concat(
            F.lit('{"data": ['),
            _record(
                F.col("entity_id"), F.col("entity_name"), F.col("snapshot_date"),
                F.col("group_name"), F.col("price_in"), F.col("price_out"),
                F.coalesce("speed", F.lit(0.0)),
                F.create_map(F.lit("index"), F.col("quality")),
            ),
            F.lit("]}"),
        ).alias("value"),
    )
