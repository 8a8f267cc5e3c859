"""Incremental loading: new landing files since the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldrank.plans.daily import Chain, Tables, load_envelopes
from fieldrank.sources.landing import stream_landing


def ingest_available(
    spark: SparkSession,
    landing_path: str,
    tables: Tables,
    chain: Chain,
    checkpoint: str,
    multi_line: bool = True,
    files_per_batch: int | None = None,
) -> None:
    """Load every landing file not seen before, then end.

    A batch replaces whole dates, so repeating one after a failure gives the
    same tables. The checkpoint remembers the files.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        load_envelopes(batch, tables, chain)

    query = (
        stream_landing(spark, landing_path, multi_line, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
