import pytest
from pyspark.sql import functions as F

from fieldrank.contracts import (
    ALLOWED_TYPES,
    CLEANED,
    ContractError,
    check_contract,
    check_types,
    contract_for,
    null_violations,
)


def test_every_problem_is_named_at_once(snapshot_rows):
    rows = snapshot_rows(("a", 1, 1, 1, 1, 1)).drop("speed").withColumns({
        "extra": F.lit(1), "quality": F.lit(1), "price_in": F.lit("1"),
    })
    with pytest.raises(ContractError) as error:
        check_contract(rows, "cleaned")
    for part in ("missing column speed", "unexpected column extra",
                 "quality is int, not double", "price_in is string, not double"):
        assert part in str(error.value)


def test_order_and_nullability_do_not_count(snapshot_rows):
    rows = snapshot_rows(("a", 1, 1, 1, 1, 1))
    check_contract(rows.select(*reversed(rows.columns)), "cleaned")


def test_open_columns(snapshot_rows):
    rows = snapshot_rows(("a", 1, 1, 1, 1, 1)).withColumn("eval_x", F.lit(1.0))
    check_contract(rows, "cleaned", open_columns=True)
    with pytest.raises(ContractError):
        check_contract(rows, "cleaned")


def test_unknown_table():
    with pytest.raises(ValueError, match="no contract for table 'other'"):
        contract_for("other")


@pytest.mark.parametrize("kind", ALLOWED_TYPES)
def test_allowed_types(spark, kind):
    check_types(spark.range(1).select(F.lit(None).cast(kind).alias("v")))


@pytest.mark.parametrize("kind", [
    "decimal(10,2)", "array<int>", "map<string,int>", "struct<a:int>",
])
def test_refused_types(spark, kind):
    with pytest.raises(ContractError, match="unsupported types: v "):
        check_types(spark.range(1).select(F.lit(None).cast(kind).alias("v")))


def test_null_violations(snapshot_rows):
    rows = snapshot_rows(("a", 1, 1, 1, 1, 1), ("b", 1, 1, 1, 1, 1)).withColumn(
        "entity_name", F.when(F.col("entity_id") == "a", F.col("entity_name"))
    )
    found = {row["column_name"]: row["nulls"] for row in null_violations(rows, CLEANED).collect()}
    assert found == {"entity_id": 0, "entity_name": 1, "snapshot_date": 0}
