"""From flat rows as they arrived to one trusted row per entity and snapshot."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldrank.functions.measures import as_double, measured
from fieldrank.names import named
from fieldrank.operators.ranking import keep_first


@dataclass(frozen=True)
class CleaningRules:
    """What to do with which column. Columns absent from the input are skipped.

    ``newest_first`` names columns (such as the file time) that decide between
    copies of a row, highest value first; they are not kept.
    """

    key: tuple[str, ...]
    identity: tuple[str, ...]
    dates: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    zero_is_missing: tuple[str, ...] = ()
    newest_first: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)


def typed(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Cast every listed column in one projection."""
    return df.select(*(_typed_column(item, rules) for item in df.schema.fields))


def _typed_column(item: T.StructField, rules: CleaningRules) -> Column:
    column = named(item.name)
    if item.name in rules.zero_is_missing:
        column = measured(column)
    elif item.name in rules.numbers or isinstance(item.dataType, T.DoubleType):
        column = as_double(column)
    elif item.name in rules.dates:
        column = column.try_cast("date")
    return column.alias(item.name)


def cast_losses(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Per listed column, how many values the casts could not read.

    A zero that means "not measured" is read, so it is no loss.
    """
    names = [n for n in (*rules.dates, *rules.numbers, *rules.zero_is_missing) if n in df.columns]
    reading = {n: _typed_column(df.schema[n], _without_zeros(rules)) for n in names}
    counts = df.agg(*(
        F.count_if(named(n).isNotNull() & reading[n].isNull()).alias(n) for n in names
    ))
    pairs = [F.struct(F.lit(n).alias("column_name"), named(n).alias("unreadable")) for n in names]
    return counts.select(F.inline(F.array(*pairs)))


def _without_zeros(rules: CleaningRules) -> CleaningRules:
    return replace(rules, numbers=rules.numbers + rules.zero_is_missing, zero_is_missing=())


def with_identity(df: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrame:
    """Drop rows that cannot be told apart: an identity column is null."""
    for name in columns:
        df = df.where(named(name).isNotNull())
    return df


def dedupe(df: DataFrame, keys: list[str], newest_first: list[str]) -> DataFrame:
    """One row per key: the newest, then the fullest, then the lowest by value.

    The order covers every column, so copies that still tie are equal and the
    result does not depend on the order in which rows arrive.
    """
    rest = sorted(set(df.columns) - set(keys) - set(newest_first))
    filled = sum((named(name).isNotNull().cast("int") for name in rest), F.lit(0))
    order = [named(name).desc_nulls_last() for name in newest_first]
    order += [filled.desc(), *(named(name).asc_nulls_last() for name in rest)]
    return keep_first(df, keys, order)


def clean(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Types, identity filter, deduplication and renames in one plan.

    Rows without identity go first, so they can never win over a usable copy.
    """
    known = [name for name in rules.newest_first if name in df.columns]
    rows = with_identity(typed(df, rules), rules.identity)
    rows = dedupe(rows, list(rules.key), known)
    return rows.drop(*known).withColumnsRenamed(rules.renames)
