"""Landing files: JSON envelopes ``{"data": [record, ...]}``, one or many per date.

Batch and stream use the same steps: envelopes -> records -> flat rows. The
snapshot date is read from the file path. An envelope is one JSON document per
file, or one per line (``multi_line=False``), which lets Spark split files.
"""

from __future__ import annotations

import datetime as dt
import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldrank.materialise import Stored, join_stored, materialise
from fieldrank.operators.cleaning import CleaningRules
from fieldrank.roles import DEFAULT_ROLES, Roles

_ENVELOPE = "data ARRAY<STRING>, _malformed STRING"
_DATE_IN_PATH = r".*(?<![0-9])([0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9])"


@dataclass(frozen=True)
class RecordLayout:
    """Where the values of a record are.

    ``paths`` must be present in each record (their values may be null) and
    become columns named with ``_`` for ``.``. ``measurements`` is an optional
    object with an open set of numeric entries.
    """

    paths: tuple[str, ...]
    measurements: str | None = None
    prefix: str = "eval_"

    def column(self, path: str) -> str:
        return path.replace(".", "_")

    @property
    def groups(self) -> dict[str, list[str]]:
        """Leaf names per parent; the root has the empty name."""
        found: dict[str, list[str]] = {"": []}
        for path in self.paths:
            parent, _, leaf = path.rpartition(".")
            if "." in parent:
                raise ValueError(f"records are nested two levels at most: {path}")
            found.setdefault(parent, []).append(leaf)
        return found


# The record format of the landing files.
RECORD = RecordLayout(
    paths=(
        "id",
        "slug",
        "release_date",
        "model_creator.slug",
        "pricing.price_1m_input_tokens",
        "pricing.price_1m_output_tokens",
        "median_output_tokens_per_second",
        "median_time_to_first_token_seconds",
        "median_time_to_first_answer_token",
    ),
    measurements="evaluations",
)


def record_rules(
    quality_key: str, layout: RecordLayout = RECORD, roles: Roles = DEFAULT_ROLES
) -> CleaningRules:
    """Cleaning of flat :data:`RECORD` rows; ``quality_key`` names the
    measurement that serves as quality."""
    # Which columns are dates, prices and measured with zero for none.
    return CleaningRules(
        key=("id", "snapshot_date"),
        identity=("id", "slug"),
        dates=("release_date", "snapshot_date"),
        numbers=("pricing_price_1m_input_tokens", "pricing_price_1m_output_tokens"),
        zero_is_missing=(
            "median_output_tokens_per_second",
            "median_time_to_first_token_seconds",
            "median_time_to_first_answer_token",
        ),
        newest_first=("file_time", "file_path"),
        renames={
            "id": roles.entity_id,
            "slug": roles.entity_name,
            "model_creator_slug": roles.group_name,
            "pricing_price_1m_input_tokens": roles.price_in,
            "pricing_price_1m_output_tokens": roles.price_out,
            "median_output_tokens_per_second": roles.speed,
            "median_time_to_first_token_seconds": "first_token_seconds",
            "median_time_to_first_answer_token": "first_answer_seconds",
            f"{layout.prefix}{quality_key}": roles.quality,
            "snapshot_date": roles.snapshot_date,
        },
    )


def _envelopes(reader, path: str, multi_line: bool) -> DataFrame:
    return (
        reader.schema(_ENVELOPE)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", "_malformed")
        .option("recursiveFileLookup", True)
        .json(path)
        .select(
            "data",
            "_malformed",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_modification_time").alias("file_time"),
        )
        .withColumn("snapshot_date", _path_date(F.col("file_path")))
    )


def _path_date(path: Column) -> Column:
    # The last date in the path: a date-named file or a date-named folder.
    return F.try_to_date(F.nullif(F.regexp_extract(path, _DATE_IN_PATH, 1), F.lit("")))


def read_landing(
    spark: SparkSession, path: str, multi_line: bool = True, date: dt.date | str | None = None
) -> DataFrame:
    """One row per envelope, with its file and date.

    ``date`` stamps all of them, for files whose path tells no date.
    """
    envelopes = _envelopes(spark.read, path, multi_line)
    if date is None:
        return envelopes
    return envelopes.withColumn("snapshot_date", F.lit(date).cast("date"))


def stream_landing(
    spark: SparkSession, path: str, multi_line: bool = True, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _envelopes(reader, path, multi_line)


def _reason() -> Column:
    return (
        F.when(F.col("snapshot_date").isNull(), "no date in path")
        .when(F.col("data").isNotNull(), F.lit(None))
        .when(F.col("_malformed").isNotNull(), "malformed")
        .otherwise("no data list")
    )


def rejected(envelopes: DataFrame) -> DataFrame:
    """Envelopes that cannot be loaded, counted per file and reason."""
    return (
        envelopes.withColumn("reason", _reason())
        .where(F.col("reason").isNotNull())
        .groupBy("file_path", "reason")
        .agg(F.count(F.lit(1)).alias("envelopes"))
    )


def _newest_of_dates(envelopes: DataFrame) -> Stored:
    usable = envelopes.where(_reason().isNull())
    stamp = F.struct("file_time", "file_path")
    return materialise(
        usable.groupBy("snapshot_date").agg(F.max(stamp).alias("_newest")).select(
            "snapshot_date", F.col("_newest.file_path").alias("file_path")
        )
    )


def _of_files(envelopes: DataFrame, files: Stored, how: str) -> DataFrame:
    on = ["snapshot_date", "file_path"]
    return join_stored(envelopes, files, on, how)


def newest_files(envelopes: DataFrame) -> DataFrame:
    """Keep each date's newest file only: a file is a whole snapshot, and a
    later one for the same date replaces it."""
    return _of_files(envelopes, _newest_of_dates(envelopes), "left_semi")


def superseded(envelopes: DataFrame) -> DataFrame:
    """What :func:`newest_files` leaves out, as :func:`rejected` tells it."""
    usable = envelopes.where(_reason().isNull())
    older = _of_files(usable, _newest_of_dates(envelopes), "left_anti")
    return (
        older.groupBy("file_path").agg(F.count(F.lit(1)).alias("envelopes"))
        .select("file_path", F.lit("superseded").alias("reason"), "envelopes")
    )


def records(envelopes: DataFrame) -> DataFrame:
    """One row per record, as JSON text with its origin."""
    return envelopes.where(_reason().isNull()).select(
        "snapshot_date", "file_path", "file_time", F.explode("data").alias("record")
    )


def _opened(rows: DataFrame, layout: RecordLayout) -> DataFrame:
    """The record parsed once, and its top-level keys.

    All values are read as text, because numbers may arrive quoted and one bad
    value must not void its neighbours. Nested objects become maps, which tell
    a null value from a missing key.
    """
    texts = T.MapType(T.StringType(), T.StringType())
    nested = [parent for parent in layout.groups if parent]
    if layout.measurements:
        nested.append(layout.measurements)
    schema = T.StructType(
        [T.StructField(leaf, T.StringType()) for leaf in layout.groups[""]]
        + [T.StructField(name, texts) for name in nested]
    )
    return rows.withColumns({
        "_r": F.from_json("record", schema), "_keys": F.json_object_keys("record"),
    })


def _has(path: str) -> Column:
    parent, _, leaf = path.rpartition(".")
    if parent:
        found = F.map_contains_key(F.col("_r")[parent], leaf)
    else:
        found = F.array_contains("_keys", leaf)
    return F.coalesce(found, F.lit(False))


def _missing(layout: RecordLayout) -> Column:
    return F.array_compact(F.array(*(F.when(~_has(path), path) for path in layout.paths)))


def incomplete_records(rows: DataFrame, layout: RecordLayout = RECORD) -> DataFrame:
    """Records that lack mandatory keys, with the keys (a null value is not missing)."""
    short = _opened(rows, layout).withColumn("missing", _missing(layout))
    return short.where(F.size("missing") > 0).select(*rows.columns, "missing")


def flatten(
    rows: DataFrame,
    layout: RecordLayout = RECORD,
    on_missing: str = "fail",
    keep_origin: bool = True,
) -> DataFrame:
    """Nested record to flat row of texts; measurements stay a map.

    A record without a mandatory key fails the job (``on_missing="fail"``) or
    gets null in its place (``"null"``).
    """
    if on_missing not in ("fail", "null"):
        raise ValueError(f"on_missing must be 'fail' or 'null', not {on_missing!r}")
    opened = _opened(rows, layout)
    if on_missing == "fail":
        # In the projection, not in a filter, which would parse a second time.
        complete = reduce(operator.and_, map(_has, layout.paths))
        message = F.concat(
            F.lit("record lacks "), F.array_join(_missing(layout), ", "), F.lit(": "), "record"
        )
        checked = F.when(complete, F.col("_r")).otherwise(F.raise_error(message))
        opened = opened.withColumn("_r", checked)
    values = []
    for path in layout.paths:
        parent, _, leaf = path.rpartition(".")
        holder = F.col("_r")[parent] if parent else F.col("_r")
        values.append(holder[leaf].alias(layout.column(path)))
    if layout.measurements:
        values.append(F.col("_r")[layout.measurements].alias(layout.measurements))
    origin = ["snapshot_date", "file_path", "file_time"] if keep_origin else ["snapshot_date"]
    return opened.select(*values, *origin)


# Keys that are looked up become columns; more of them are an error.
MOST_KEYS = 2_000


def map_keys(df: DataFrame, column: str, at_most: int = MOST_KEYS) -> list[str]:
    """The distinct keys of a map column, sorted. They become column names, so
    a set too large for a schema is an error."""
    keys = df.select(F.explode(F.map_keys(column)).alias("key")).distinct()
    found = [row.key for row in keys.limit(at_most + 1).collect()]
    if len(found) > at_most:
        raise ValueError(f"{column} has more than {at_most} keys; name the wanted ones")
    return sorted(found)


def spread_map(
    df: DataFrame, column: str, keys: list[str] | None = None, prefix: str = RECORD.prefix,
    at_most: int = MOST_KEYS,
) -> DataFrame:
    """One double column per map key; absent keys and non-numbers are null.

    Without ``keys`` they are looked up first (one pass over the column), up to
    ``at_most``; :func:`long_form` has no such limit. Column names do not tell
    case, so keys that differ in case only share a column, named by the first.
    """
    keys = map_keys(df, column, at_most) if keys is None else keys
    spellings: dict[str, list[str]] = {}
    for key in keys:
        spellings.setdefault(key.lower(), []).append(key)
    spread = {
        f"{prefix}{same[0]}": F.coalesce(*(
            F.col(column)[F.lit(key)].try_cast("double") for key in same
        ))
        for same in spellings.values()
    }
    return df.withColumns(spread).drop(column) if spread else df.drop(column)


def long_form(df: DataFrame, column: str) -> DataFrame:
    """One row per map entry (``key``, ``value``) instead of a column per key."""
    others = [name for name in df.columns if name != column]
    return df.select(*others, F.explode(column).alias("key", "_text")).select(
        *others, "key", F.col("_text").try_cast("double").alias("value")
    )
