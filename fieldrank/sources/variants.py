"""Open measurements kept as VARIANT: any number of keys, values of any kind.

A record is parsed once and its measurements are stored as one VARIANT column, so a key
that appears or a value that changes its kind needs no other table. Values are read by
key and type when they are wanted. What the snapshots held is told by key states: per
date and key the kinds of its values. They are as small as dates times keys, and the
drift between dates comes from them without reading the measurements again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldrank.materialise import join_stored, materialise
from fieldrank.names import named
from fieldrank.roles import DEFAULT_ROLES, Roles
from fieldrank.sources import store
from fieldrank.sources.landing import RECORD, RecordLayout

MEASURED = "measured"


def measured_records(
    rows: DataFrame, layout: RecordLayout = RECORD, out: str = MEASURED
) -> DataFrame:
    """The rows of ``landing.records`` with their measurements as VARIANT (``out``)
    instead of the text, and the record's other top-level values as texts.

    Text that is no JSON and records without measurements have null there.
    """
    parsed = rows.withColumn("_record", F.try_parse_json("record"))
    others = [
        F.try_variant_get("_record", _path(leaf), "string").alias(leaf) for leaf in layout.groups[""]
    ]
    kept = [name for name in rows.columns if name != "record"]
    return parsed.select(
        *kept, *others,
        F.try_variant_get("_record", _path(layout.measurements), "variant").alias(out),
    )


def write_measured(df: DataFrame, root: str, roles: Roles = DEFAULT_ROLES) -> store.Load:
    """Store rows with VARIANT columns; the dates found in them are replaced."""
    return store.write_snapshots(df, root, day=roles.snapshot_date, roles=roles, more_types=("variant",))


def _path(key: str) -> str:
    quote = "'" if "'" not in key else '"'
    if quote in key:
        raise ValueError(f"a key with both kinds of quotes cannot be looked up: {key}")
    return f"$[{quote}{key}{quote}]"


def value_of(key: str, kind: str = "double", column: str = MEASURED) -> Column:
    """The value of a key as ``kind``; null if it is absent or cannot be read as such."""
    return F.try_variant_get(named(column), _path(key), kind)


def entries(df: DataFrame, column: str = MEASURED) -> DataFrame:
    """One row per key of the measurements (``key``, ``value`` as VARIANT, ``kind``).

    Kinds are those of JSON: number, string, boolean, object, array and null.
    """
    others = [named(name) for name in df.columns if name != column]
    opened = df.lateralJoin(df.sparkSession.tvf.variant_explode(named(column).outer()))
    schema = F.schema_of_variant("value")
    kind = (
        F.when(schema == "VOID", "null").when(schema == "STRING", "string")
        .when(schema == "BOOLEAN", "boolean").when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("ARRAY"), "array").otherwise("number")
    )
    return opened.where(F.col("key").isNotNull()).select(*others, "key", "value", kind.alias("kind"))


def date_schemas(df: DataFrame, column: str = MEASURED, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """The common schema of each date's measurements (``measured_schema``)."""
    return df.groupBy(roles.snapshot_date).agg(
        F.schema_of_variant_agg(named(column)).alias("measured_schema")
    )


def key_states(df: DataFrame, column: str = MEASURED, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Per date and key: rows, rows with null, and the kinds of the others, sorted.

    A date whose rows have no keys has one row with a null key, so it counts as a date.
    """
    day = roles.snapshot_date
    found = entries(df.select(day, column), column)
    dates = df.groupBy(day).agg(F.lit(None).cast("string").alias("key"))
    # Counted by kind first: a key may be in every row, but has six kinds at most.
    kinds = found.groupBy(day, "key", "kind").agg(F.count(F.lit(1)).alias("_n"))
    states = kinds.groupBy(day, "key").agg(
        F.sum("_n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("kind") == "null", F.col("_n"))), F.lit(0)).alias("n_null"),
        F.sort_array(F.collect_set(F.when(F.col("kind") != "null", F.col("kind")))).alias("kinds"),
    )
    without = dates.join(kinds.select(day).distinct(), day, "left_anti")
    return states.unionByName(without, allowMissingColumns=True)


def drift(states: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """What changed between each date and the one before it.

    ``new``: a key never seen before; ``back``: one that was seen, but not at the date
    before; ``gone``: one that was there at the date before; ``kinds``: a key whose
    values have other kinds than when it last had any. The first date has no changes.
    """
    day = roles.snapshot_date
    places = Window.orderBy(day)  # over distinct dates only
    calendar = materialise(states.select(day).distinct().select(
        day,
        F.row_number().over(places).alias("_number"),
        F.lead(day).over(places).alias("_after"),
    ))
    by_key = Window.partitionBy("key").orderBy("_number")
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    kinds = F.when(F.size("kinds") > 0, F.col("kinds"))
    rows = join_stored(
        states.where(F.col("key").isNotNull()).select(day, "key", "kinds"), calendar, [day]
    ).withColumns({
        "_last": F.lag("_number").over(by_key),
        "_next": F.lead("_number").over(by_key),
        "_kinds": F.last(kinds, ignorenulls=True).over(earlier),
    })

    def change(when: Column, at: Column, name: str) -> Column:
        none = F.lit(None).cast("array<string>")
        return F.when(when, F.struct(
            at.alias("day"), F.lit(name).alias("change"),
            (F.col("kinds") if name == "gone" else F.col("_kinds")).alias("kinds_before"),
            (none if name == "gone" else F.col("kinds")).alias("kinds_now"),
        ))

    here, number = F.col(day), F.col("_number")
    changes = F.array_compact(F.array(
        change(F.col("_last").isNull() & (number > 1), here, "new"),
        change(F.col("_last") < number - 1, here, "back"),
        change((F.size("kinds") > 0) & (F.col("_kinds") != F.col("kinds")), here, "kinds"),
        change(
            F.col("_after").isNotNull() & ~F.col("_next").eqNullSafe(number + 1), F.col("_after"), "gone"
        ),
    ))
    return rows.select("key", F.explode(changes).alias("_c")).select(
        F.col("_c.day").alias(day), "key", "_c.change", "_c.kinds_before", "_c.kinds_now"
    )
