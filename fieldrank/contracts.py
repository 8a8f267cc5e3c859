"""What the stored tables must look like, and checks against it."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldrank.names import named
from fieldrank.roles import DEFAULT_ROLES, Roles

# Column types a stored table may use.
ALLOWED_TYPES = ("string", "double", "float", "int", "bigint", "date", "boolean", "timestamp")


class ContractError(ValueError):
    """A frame does not match the contract of its table."""


def _struct(required: str, **columns: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(name, kind, name not in required.split()) for name, kind in columns.items()]
    )


_TEXT, _DATE, _NUMBER, _COUNT = T.StringType(), T.DateType(), T.DoubleType(), T.LongType()

# The columns of the stored tables.
CLEANED = _struct(
    "entity_id entity_name snapshot_date",
    entity_id=_TEXT, entity_name=_TEXT, group_name=_TEXT, snapshot_date=_DATE,
    quality=_NUMBER, speed=_NUMBER, price_in=_NUMBER, price_out=_NUMBER,
)

LEADERBOARD = _struct(
    "snapshot_date rank entity_id entity_name composite_score",
    snapshot_date=_DATE, rank=_COUNT,
    entity_id=_TEXT, entity_name=_TEXT, group_name=_TEXT,
    composite_score=_NUMBER, quality_norm=_NUMBER, speed_norm=_NUMBER, price_norm=_NUMBER,
    mean_price=_NUMBER, value_ratio=_NUMBER, cost_tier=_TEXT, efficiency_rank=_COUNT,
)

TRENDS = _struct(
    "entity_id entity_name snapshot_date",
    entity_id=_TEXT, entity_name=_TEXT, group_name=_TEXT,
    snapshot_date=_DATE, prev_snapshot_date=_DATE,
    quality_current=_NUMBER, quality_previous=_NUMBER, quality_delta=_NUMBER,
    speed_current=_NUMBER, speed_previous=_NUMBER, speed_delta=_NUMBER,
    price_current=_NUMBER, price_previous=_NUMBER, price_delta=_NUMBER,
)

CONTRACTS = {"cleaned": CLEANED, "leaderboard": LEADERBOARD, "trends": TRENDS}


def contract_for(table: str, roles: Roles = DEFAULT_ROLES) -> T.StructType:
    """The contract of a table, under the installation's column names."""
    if table not in CONTRACTS:
        raise ValueError(f"no contract for table {table!r}; known: {sorted(CONTRACTS)}")
    names = {getattr(DEFAULT_ROLES, f.name): getattr(roles, f.name) for f in fields(Roles)}
    return T.StructType([
        T.StructField(names.get(f.name, f.name), f.dataType, f.nullable)
        for f in CONTRACTS[table].fields
    ])


def completed(df: DataFrame, contract: T.StructType) -> DataFrame:
    """``df`` with the optional columns it lacks as typed nulls."""
    absent = [f for f in contract.fields if f.nullable and f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})


def contract_problems(
    schema: T.StructType, contract: T.StructType, open_columns: bool = False
) -> list[str]:
    """All differences by name and type; order and nullability do not count.

    ``open_columns`` accepts columns beyond the contract (a cleaned table grows
    one per new measurement).
    """
    wanted = {f.name: f.dataType.simpleString() for f in contract.fields}
    found = {f.name: f.dataType.simpleString() for f in schema.fields}
    problems = [f"missing column {name}" for name in wanted if name not in found]
    if not open_columns:
        problems += [f"unexpected column {name}" for name in found if name not in wanted]
    problems += [
        f"column {name} is {found[name]}, not {wanted[name]}"
        for name in wanted
        if name in found and found[name] != wanted[name]
    ]
    return problems


def check_contract(
    df: DataFrame, table: str, open_columns: bool = False, roles: Roles = DEFAULT_ROLES
) -> None:
    """Raise one error naming everything that does not fit ``table``."""
    problems = contract_problems(df.schema, contract_for(table, roles), open_columns)
    if problems:
        raise ContractError(f"{table}: " + "; ".join(problems))


def check_types(df: DataFrame, allowed: Iterable[str] = ALLOWED_TYPES) -> None:
    """Raise if a column has a type that stored tables do not use."""
    allowed = set(allowed)
    refused = [
        f"{f.name} {f.dataType.simpleString()}"
        for f in df.schema.fields
        if f.dataType.simpleString() not in allowed
    ]
    if refused:
        raise ContractError("unsupported types: " + ", ".join(refused))


def null_violations(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Per required column, the number of rows that lack it (one aggregation)."""
    required = [f.name for f in contract.fields if not f.nullable and f.name in df.columns]
    counts = df.agg(*(F.count_if(named(name).isNull()).alias(name) for name in required))
    pairs = F.array(*(
        F.struct(F.lit(name).alias("column_name"), named(name).alias("nulls"))
        for name in required
    ))
    return counts.select(F.inline(pairs))
