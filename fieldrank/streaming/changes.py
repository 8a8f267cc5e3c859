"""Changes of each entity while its rows arrive, from keyed state.

The state is the last row of each entity. A new row is compared with it and takes its
place, so no history is read. Entities that stay away longer than ``idle_days`` are
forgotten by a timer. What the state cannot answer is settled by a batch join that
recomputes only the entities concerned: those with a row at or before their last one,
with a row too late for the stream (more than ``late_days`` behind the newest date,
which Spark leaves out), or back after they were forgotten.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fieldrank.materialise import join_stored, materialise
from fieldrank.operators.statistics import with_mean_price
from fieldrank.operators.trends import trends
from fieldrank.roles import DEFAULT_ROLES, Roles

IDLE_DAYS = 90
LATE_DAYS = 7
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_METRICS = ("quality", "speed", "price")
_STATE = "day date, quality double, speed double, price double"


def _out_schema(roles: Roles) -> str:
    texts = ", ".join(f"`{name}` string" for name in roles.identity)
    metrics = ", ".join(
        f"{m}_current double, {m}_previous double, {m}_delta double" for m in _METRICS
    )
    return (
        f"{texts}, `{roles.snapshot_date}` date, prev_snapshot_date date, {metrics}, "
        "first boolean, late boolean"
    )


class LastRow(StatefulProcessor):
    """Keeps the last row of an entity and emits its changes."""

    def __init__(self, roles: Roles, idle_days: int):
        self.roles, self.idle = roles, dt.timedelta(days=idle_days)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        day = self.roles.snapshot_date
        last = self.last.get() if self.last.exists() else None
        out = []
        given = pd.concat(list(rows)).sort_values(day)
        for row in given.to_dict("records"):
            now = [None if pd.isna(row[m]) else float(row[m]) for m in _METRICS]
            date = row[day]
            late = last is not None and date <= last[0]
            known = None if late else last
            values = []
            for i, value in enumerate(now):
                before = known[i + 1] if known is not None else None
                delta = None if value is None or before is None else value - before
                values += [value, before, delta]
            out.append([
                *[row[name] for name in self.roles.identity], date,
                known[0] if known is not None else None, *values, last is None, late,
            ])
            if not late:
                last = (date, *now)
        if last is not None:
            self.last.update(tuple(last))
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            leaves = dt.datetime.combine(last[0], dt.time(), dt.timezone.utc) + self.idle
            self.handle.registerTimer(int(leaves.timestamp() * 1000))
        names = [
            *self.roles.identity, day, "prev_snapshot_date",
            *[f"{m}_{part}" for m in _METRICS for part in ("current", "previous", "delta")],
            "first", "late",
        ]
        yield pd.DataFrame(out, columns=names, dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_changes(
    rows: DataFrame,
    out: str,
    checkpoint: str,
    roles: Roles = DEFAULT_ROLES,
    idle_days: int = IDLE_DAYS,
    late_days: int = LATE_DAYS,
) -> None:
    """Write the changes of all rows not seen before to ``out``, then end.

    ``rows`` is a stream of cleaned rows. A batch that runs again after a failure
    replaces its own folder; state and progress are in ``checkpoint``.
    """
    day = roles.snapshot_date
    spark = rows.sparkSession
    keyed = (
        with_mean_price(rows, roles)
        .select(
            *roles.identity, day, F.col(roles.quality).cast("double").alias("quality"),
            F.col(roles.speed).cast("double").alias("speed"), F.col("mean_price").alias("price"),
            F.col(day).cast("timestamp").alias("_time"),
        )
        .withWatermark("_time", f"{late_days} days")
        .groupBy(roles.entity_id)
        .transformWithStateInPandas(
            LastRow(roles, idle_days), _out_schema(roles), "append", "EventTime"
        )
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        query = (
            keyed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def settled(changes: DataFrame, cleaned: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """The changes, with all rows of those entities made from the table that the state
    could not answer for; the others stay as they were emitted."""
    entity, day = roles.entity_id, roles.snapshot_date
    emitted = changes.where("not late").select(
        F.col(entity).alias("_e"), F.col(day).alias("_d"), *[f"{m}_current" for m in _METRICS]
    )
    now = with_mean_price(cleaned, roles)
    values = dict(zip(_METRICS, (roles.quality, roles.speed, "mean_price")))
    equal = (F.col("_e") == F.col(entity)) & (F.col("_d") == F.col(day))
    for metric, name in values.items():
        equal = equal & F.col(f"{metric}_current").eqNullSafe(F.col(name))
    unseen = now.join(emitted, equal, "left_anti").select(entity)
    unsure = changes.groupBy(entity).agg(
        F.max("late").alias("_late"), F.count_if("first").alias("_firsts")
    ).where("_late or _firsts > 1").select(entity)
    open_ones = materialise(unseen.union(unsure).distinct())
    ready = join_stored(changes, open_ones, [entity], "left_anti")
    names = [name for name in changes.columns if name not in ("first", "late", "batch")]
    again = trends(join_stored(cleaned, open_ones, [entity], "left_semi"), roles)
    return ready.select(*names).unionByName(again.select(*names))


def read_changes(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out)
