"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldrank.materialise import Stored

# Bytes of words are kept, A-Z lower-cased, all other ASCII becomes a space.
_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
WORD_BYTES = bytes(
    c if c in _KEPT else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

# Java and DuckDB read the same pattern.
WORD = r"[^\x20\x09-\x0D]+"

# Makes, once per task, the function that turns texts into new columns.
Maker = Callable[[], Callable[[list[bytes | None]], list[pa.Array]]]


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed names; other columns cannot clash."""
    return df.select(*[F.col(quoted(name)).alias(out) for out, name in columns.items()])


def whole(df: DataFrame) -> DataFrame:
    """Every row as one struct ``doc``, so that added columns cannot clash."""
    return df.select(F.struct(*[F.col(quoted(name)) for name in df.columns]).alias("doc"))


def unpacked(df: DataFrame) -> DataFrame:
    """The rows that ``whole`` packed."""
    fields = df.schema["doc"].dataType.fieldNames()
    return df.select(*[F.col("doc").getField(name).alias(name) for name in fields])


# Bytes of text that a Python worker turns into objects at once.
_SLICE = 4 * 1024 * 1024


def slices(batch: pa.RecordBatch, texts: pa.Array) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of a batch with their texts, each of about ``_SLICE`` bytes or one row."""
    texts = texts.cast(pa.binary())
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    part = np.cumsum(sizes) // _SLICE
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    for start, end in zip(cuts, cuts[1:]):
        if start < end:
            yield batch.slice(start, end - start), texts.slice(start, end - start).to_pylist()


def with_columns_of_text(
    packed: DataFrame, text: str, make: Maker, added: list[T.StructField], keep: list[str]
) -> DataFrame:
    """Add columns made from a text to rows packed by ``whole``.

    Columns besides ``doc`` stay. ``keep`` are the fields of ``doc`` to return; a
    plan that needs no text after this leaves it out. Spark cuts the batches at
    its limits of rows and bytes, and texts become Python objects slice by slice.
    """
    fields = {f.name: f for f in packed.schema["doc"].dataType.fields}
    others = [f for f in packed.schema.fields if f.name != "doc"]
    schema = T.StructType(
        [T.StructField("doc", T.StructType([fields[name] for name in keep])), *others, *added]
    )

    places = {name: i for i, name in enumerate(fields)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for whole_batch in batches:
            for batch, texts in slices(whole_batch, whole_batch.column("doc").field(text)):
                doc = batch.column("doc").flatten()
                kept = pa.StructArray.from_arrays([doc[places[n]] for n in keep], names=keep)
                columns = [kept, *[batch.column(f.name) for f in others], *function(texts)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return packed.mapInArrow(run, schema)


def join_measured(rows: DataFrame, side: Stored, on: list[str], how: str) -> DataFrame:
    """Join a written side: broadcast below the measured bound, else by shuffle.

    In the shuffle a hot key of ``rows`` is split at run time (skew join).
    """
    return rows.join(F.broadcast(side.df) if side.fits_broadcast else side.df, on, how)
