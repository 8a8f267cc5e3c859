"""Results that are written once and read back, with their size known.

Two things need a result that is really finished before the plan goes on:
a side that may be broadcast (its size has to be known, not estimated) and a
range placement (sampled again, its boundaries could move). Both are written
to the shared folder named by ``spark.checkpoint.dir``, so they also survive
the loss of executors.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field
from functools import cache
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldrank.names import named

# A side is broadcast only when both of its measured sizes stay below these.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class Stored:
    """A written result with the sizes counted while it was written."""

    df: DataFrame
    rows: int
    nbytes: int
    observed: dict[str, Any] = field(default_factory=dict)

    @property
    def fits_broadcast(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.nbytes <= BROADCAST_BYTES


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name below the session's checkpoint directory."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = base or _own_folder(context.applicationId)
    return f"{base.rstrip('/')}/fieldrank/{context.applicationId}/{uuid.uuid4().hex}"


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="fieldrank-")


def observed_metrics(observation: Observation) -> dict[str, Any]:
    """Metrics of a finished write; empty when the plan was folded to no rows."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


def row_bytes(schema: T.StructType) -> Column:
    """Payload size of a row: fixed widths plus the length of each text, of nested
    values that of their elements."""
    sizes = (_value_bytes(named(item.name), item.dataType) for item in schema.fields)
    return sum(sizes, F.lit(0)).cast("long")


def _value_bytes(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, T.VariantType):
        return F.coalesce(F.octet_length(F.to_json(value)), F.lit(0)) + 16
    if isinstance(kind, T.StructType):
        parts = (_value_bytes(value.getField(f.name), f.dataType) for f in kind.fields)
        return sum(parts, F.lit(16))
    if isinstance(kind, T.ArrayType):
        nested = (T.StringType, T.BinaryType, T.StructType, T.ArrayType, T.MapType)
        if not isinstance(kind.elementType, nested):
            return 16 * (1 + F.greatest(F.size(value), F.lit(0)))
        add = F.aggregate(
            value, F.lit(16).cast("long"),
            lambda n, x: n + _value_bytes(x, kind.elementType).cast("long"),
        )
        return F.coalesce(add, F.lit(16).cast("long"))
    if isinstance(kind, T.MapType):
        keys = _value_bytes(F.map_keys(value), T.ArrayType(kind.keyType))
        return keys + _value_bytes(F.map_values(value), T.ArrayType(kind.valueType))
    return F.lit(16)


def materialise(df: DataFrame, codec: str | None = None, **observed: Column) -> Stored:
    """Write ``df`` to the shared folder and read it back.

    ``codec`` is the compression, if not the session's. ``observed`` are extra
    aggregates taken in the same pass.
    """
    spark = df.sparkSession
    path = scratch_folder(spark)
    seen = Observation()
    metrics = [
        F.count(F.lit(1)).alias("rows"),
        F.sum(row_bytes(df.schema)).alias("nbytes"),
        *(column.alias(name) for name, column in observed.items()),
    ]
    df.observe(seen, *metrics).write.parquet(path, compression=codec)
    found = observed_metrics(seen)
    return Stored(
        df=spark.read.schema(df.schema).parquet(path),
        rows=found.get("rows") or 0,
        nbytes=found.get("nbytes") or 0,
        observed={name: found.get(name) for name in observed},
    )


def join_stored(rows: DataFrame, side: Stored, on: list[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` with a written side.

    A side below the measured bound is broadcast, so ``rows`` does not move. A larger
    side is joined by shuffle, each of its rows once; adaptive execution splits the
    tasks of hot keys of ``rows`` by their measured sizes (inner, left, semi and anti
    joins), and only for these does a task's part of the side go to several tasks.
    """
    return rows.join(F.broadcast(side.df) if side.fits_broadcast else side.df, on, how)
